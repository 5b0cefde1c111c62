"""Lists, bounds and category names that results depend on.

They are data, not logic. Change them only together with the expected results.
"""

# Room types kept as they are; anything else becomes "Other".
ROOM_TYPES = ["Entire home/apt", "Private room", "Shared room", "Hotel room"]

# Raw property type -> normalised property type; anything else becomes "Other".
PROPERTY_TYPES = {
    "Entire rental unit": "Entire rental unit",
    "Private room in rental unit": "Private room in rental unit",
    "Entire condo": "Entire condo",
    "Entire home": "Entire home",
    "Private room in home": "Private room in home",
    "Entire loft": "Entire loft",
    "Entire serviced apartment": "Entire serviced apartment",
    "Room in hotel": "Hotel room",
    "Shared room in rental unit": "Shared room",
    "Entire guest suite": "Entire guest suite",
    "Private room in guest suite": "Private room in guest suite",
    "Private room in bed and breakfast": "Bed and breakfast",
    "Entire vacation home": "Entire vacation home",
    "Boat": "Boat",
    "Houseboat": "Houseboat",
    "Tiny home": "Tiny home",
}

# Room type -> category of the room-type dimension.
ROOM_CATEGORIES = {
    "Entire home/apt": "Entire Place",
    "Private room": "Shared",
    "Shared room": "Shared",
    "Hotel room": "Hotel",
}

# City bounding box (latitude, longitude) and country bounding box, both inclusive.
CITY_BOX = (52.20, 52.50, 4.70, 5.10)
COUNTRY_BOX = (50.7, 53.6, 3.3, 7.3)

# Right-closed price tiers.
PRICE_TIER_EDGES = [0.0, 80.0, 150.0, 300.0, float("inf")]
PRICE_TIER_LABELS = ["Budget (≤€80)", "Mid-range (€81–€150)", "Premium (€151–€300)", "Luxury (>€300)"]

# Right-closed host portfolio sizes.
HOST_SEGMENT_EDGES = [0.0, 1.0, 5.0, 20.0, float("inf")]
HOST_SEGMENT_LABELS = ["Single-listing", "Small (2-5)", "Medium (6-20)", "Commercial (20+)"]

# Right-closed price buckets of the error report.
ERROR_BUCKET_EDGES = [0.0, 80.0, 150.0, 300.0, 600.0, 50000.0]
ERROR_BUCKET_LABELS = ["Budget ≤€80", "Mid €81-150", "Premium €151-300", "High €301-600", "Luxury €600+"]

# Phrases of generated reviews (regular expression over lower-cased text).
AUTO_REVIEW_PATTERN = "the host canceled|automatically collected|this is an automated"

DAYS_PER_MONTH = 30.44
DAYS_PER_YEAR = 365.25
NO_MAXIMUM_NIGHTS = 2147483647

# Columns that must be present per data set.
REQUIRED_COLUMNS = {
    "listings": ["id", "host_id", "price", "room_type", "latitude", "longitude", "neighbourhood_cleansed"],
    "calendar": ["listing_id", "date", "available", "price", "adjusted_price", "minimum_nights", "maximum_nights"],
    "reviews": ["listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments"],
    "neighbourhoods": ["neighbourhood"],
}

# Business-critical fields and what a missing value means.
CRITICAL_FIELDS = {
    "listings": {
        "price": "Cannot price-analyse this listing",
        "latitude": "Cannot map or geo-analyse",
        "longitude": "Cannot map or geo-analyse",
        "neighbourhood_cleansed": "Cannot assign to neighbourhood",
        "room_type": "Cannot segment by room type",
        "review_scores_rating": "Cannot assess listing quality",
        "bedrooms": "Cannot compute price-per-bedroom",
        "host_is_superhost": "Cannot segment by host tier",
    },
    "calendar": {
        "price": "Cannot perform seasonal price analysis",
        "date": "Cannot perform temporal analysis",
        "available": "Cannot estimate occupancy",
    },
    "reviews": {
        "comments": "Cannot perform sentiment/NLP analysis",
        "date": "Cannot perform temporal review trend analysis",
        "listing_id": "Cannot link review to listing",
    },
}

LISTING_DATES = ["host_since", "first_review", "last_review", "last_scraped", "calendar_last_scraped"]
LISTING_FLAGS = [
    "host_is_superhost", "host_has_profile_pic", "host_identity_verified", "instant_bookable", "has_availability",
]
LISTING_PERCENTS = ["host_response_rate", "host_acceptance_rate"]
LISTING_NUMBERS = [
    "accommodates", "bedrooms", "beds", "minimum_nights", "maximum_nights",
    "minimum_minimum_nights", "maximum_minimum_nights", "minimum_maximum_nights", "maximum_maximum_nights",
    "minimum_nights_avg_ntm", "maximum_nights_avg_ntm",
    "number_of_reviews", "number_of_reviews_ltm", "number_of_reviews_l30d", "number_of_reviews_ly",
    "availability_30", "availability_60", "availability_90", "availability_365", "availability_eoy",
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_communication", "review_scores_location", "review_scores_value",
    "host_listings_count", "host_total_listings_count", "calculated_host_listings_count",
    "calculated_host_listings_count_entire_homes", "calculated_host_listings_count_private_rooms",
    "calculated_host_listings_count_shared_rooms",
    "reviews_per_month", "estimated_occupancy_l365d", "estimated_revenue_l365d",
]

# Defaults used when the master table is served to reports.
SERVING_DEFAULTS = {
    "bathrooms": 1.0, "bedrooms": 1.0, "beds": 1.0, "accommodates": 2.0, "price": 0.0,
    "review_scores_rating": 4.5, "availability_365": 0.0, "minimum_nights": 1.0, "number_of_reviews": 0.0,
    "occupancy_rate": 0.0, "estimated_annual_revenue_computed": 0.0,
}

# Columns of the profiling configuration: identifier, fuzzy column, outlier columns.
PROFILE_CONFIG = {
    "listings": ("id", "name", [
        "price", "availability_365", "number_of_reviews", "minimum_nights",
        "estimated_revenue_l365d", "estimated_occupancy_l365d",
    ]),
    "calendar": ("listing_id", None, ["price", "minimum_nights", "maximum_nights"]),
    "reviews": ("id", None, []),
    "neighbourhoods": (None, None, []),
}

# Columns of the correlation matrix, the rank correlation, and the regression.
PEARSON_COLUMNS = [
    "price", "accommodates", "bedrooms", "bathrooms", "beds", "availability_365", "minimum_nights",
    "number_of_reviews", "review_scores_rating", "occupancy_rate", "estimated_annual_revenue_computed",
]
SPEARMAN_COLUMNS = [
    "price", "accommodates", "bedrooms", "beds", "minimum_nights", "number_of_reviews", "reviews_per_month",
    "review_scores_rating", "availability_365", "host_tenure_years", "host_total_listings_count",
    "neighbourhood_median_price", "occupancy_rate",
]
SUMMARY_COLUMNS = [
    "price", "accommodates", "bedrooms", "beds", "number_of_reviews", "reviews_per_month",
    "review_scores_rating", "availability_365", "occupancy_rate", "estimated_annual_revenue_computed",
    "host_tenure_years",
]
REGRESSION_COLUMNS = [
    "accommodates", "bedrooms", "minimum_nights", "number_of_reviews", "review_scores_rating",
    "is_entire_home", "is_private_room", "is_superhost", "host_tenure_years", "neighbourhood_median_price",
    "availability_365",
]

# Columns of the prepared model table and the final feature list, in model order.
ML_COLUMNS = [
    "price", "room_type", "property_type", "accommodates", "bedrooms", "bathrooms", "beds", "availability_365",
    "minimum_nights", "number_of_reviews", "review_scores_rating", "host_is_superhost", "instant_bookable",
    "neighbourhood_cleansed",
]
MODEL_FEATURES = [
    "accommodates", "bedrooms", "bathrooms", "beds", "availability_365", "minimum_nights", "number_of_reviews",
    "review_scores_rating", "guests_per_bedroom", "review_density", "is_superhost", "has_reviews", "is_popular",
    "room_Hotel room", "room_Private room", "room_Shared room",
]

# Feature -> report label.
FEATURE_LABELS = {
    "accommodates": "Guest Capacity",
    "bedrooms": "Bedrooms Count",
    "bathrooms": "Bathrooms Count",
    "beds": "Beds Count",
    "availability_365": "Yearly Availability",
    "minimum_nights": "Minimum Stay Nights",
    "number_of_reviews": "Number of Reviews",
    "review_scores_rating": "Review Score Rating",
    "guests_per_bedroom": "Guests-per-Bedroom Density",
    "review_density": "Booking Frequency Ratio",
    "is_superhost": "Superhost Credentials",
    "has_reviews": "Has Reviews Active",
    "is_popular": "Listing Popularity Rating",
    "room_Hotel room": "Room Type: Hotel Room",
    "room_Private room": "Room Type: Private Room",
    "room_Shared room": "Room Type: Shared Room",
}

# Feature -> phrase of the explanation sentence (printf format, argument is the feature value;
# a trailing "int" truncates the value first).
FEATURE_PHRASES = {
    "accommodates": ("guest capacity of %d", "int"),
    "bedrooms": ("%d bedroom(s)", "int"),
    "bathrooms": ("%s bathroom(s)", "text"),
    "beds": ("%d bed(s)", "int"),
    "availability_365": ("availability of %d days per year", "int"),
    "minimum_nights": ("minimum stay of %d night(s)", "int"),
    "number_of_reviews": ("review count (%d)", "int"),
    "review_scores_rating": ("rating of %.2f/5", "float"),
    "guests_per_bedroom": ("density of %.1f guests per bedroom", "float"),
    "review_density": ("high booking-review density", None),
    "is_superhost": ("host's Superhost status", None),
    "room_Hotel room": ("being a Hotel room", None),
    "room_Private room": ("being a Private room", None),
    "room_Shared room": ("being a Shared room", None),
}

# Sentences of the explanation text.
RAISES_PREFIX = "This listing is priced higher mainly because of its "
LOWERS_PREFIX = "Conversely, its price is moderated or reduced due to its "
NO_DRIVER_TEXT = (
    "This listing's price is close to the average market baseline, "
    "with no single feature dominating the valuation."
)

# Scoring defaults for a candidate listing.
CANDIDATE_DEFAULTS = {
    "accommodates": 2, "bedrooms": 1.0, "bathrooms": 1.0, "beds": 1.0, "availability_365": 180,
    "minimum_nights": 2, "number_of_reviews": 10, "review_scores_rating": 4.5, "is_superhost": False,
    "room_type": "Entire home/apt",
}
