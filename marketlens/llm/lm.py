"""LM scoring with a log-bilinear model trained by noise-contrastive estimation.

Every token has a slot: the commonest ones have one of their own, all others share theirs with tokens of the same hash and
have their add-one share of it. Slots number up to SLOTS and grow with the vocabulary below that; they form a grid of about
as many classes as members in a class. A context vector is the sum of the two preceding tokens' vectors, each scaled by its
position. A token's probability is a softmax over the classes times a softmax over the members of its class, both products
of the context vector with a matrix, times its share of the slot. All three are normalised.

Both levels are trained by noise-contrastive estimation in numpy, in one step for some thousand tokens: noise of the classes is
shared by all of them, that of the members by those of a class. A task runs over its texts block by block from the same start,
and the vectors are averaged over the tasks by the steps that moved them, for several rounds. The model is of bounded
size and broadcast. Counts of all tokens are a table: the tail's are joined to the texts that hold them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.text import LOWER, blocks, lists, longs, utf8, word_hashes, words
from marketlens.sizing import cut_lineage

#: Slots at most (a power of two; 2 x 17 floats each), the share of them that tokens may have for their own, vector width.
SLOTS, OWN_SHARE, WIDTH = 1 << 16, 0.75, 16
#: Tokens of fewer training occurrences have no slot of their own.
MIN_COUNT = 5
#: Tokens of a step by classes, noise that a step's tokens share, also inside each class, rate, rounds of averaging.
STEP, NOISE, RATE, ROUNDS = 128, 48, 0.1, 2
#: Rows that are summed one by one at most, contexts that are scored at once.
SHORT, ROWS = 6, 256
#: Tokens that follow one another in a step.
STRETCH = 16
#: Tokens scored at a time; tokens after which a task hands over its vectors and starts again.
TOKENS, HANDOVER = 1 << 18, 1 << 25
#: Parts of an octave by which counts are ranked for the slots of their own.
OCTAVE = 32
#: Bits of a hash by which tokens with slots of their own are looked up.
DIRECTORY = 18
#: Kinds of vectors: contexts, members, classes, positions.
CONTEXT, MEMBER, CLASS, SCALE = range(4)
HELD_OUT, FOLDS = 2, 7
END = np.uint64(0x5851F42D4C957F2D)


def _tokens(texts):
    """Hash of every token, with an end after each text's words, and the bounds of each text's."""
    raw, bounds = utf8(texts)
    data = LOWER[raw]
    starts, ends, first = words(data, bounds)
    docs = len(bounds) - 1
    h = np.full(len(starts) + docs, END)
    h[np.arange(len(starts)) + np.repeat(np.arange(docs), np.diff(first))] = word_hashes(data, starts, ends)
    return h, first + np.arange(docs + 1)


def _counts(batches):
    held, size = [], 0

    def flush():
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([longs(h), pa.array(n)], names=["h", "c"])

    for batch in batches:
        for part in blocks(batch):
            held.append(_tokens(part.column("text"))[0])
            size += len(held[-1])
            if size > 1 << 20:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


@dataclass
class Space:
    """Where tokens lie: hashes, counts and places of those with slots of their own, and the slots' training mass.

    Slots are numbered class by class, `members` to a class. `shared` and `kinds` are the occurrences and the distinct tokens
    of each of the shared slots, which follow `own` in the order of dealing.
    """

    own: np.ndarray
    count: np.ndarray
    classes: int
    members: int
    shared: np.ndarray
    kinds: np.ndarray

    def __post_init__(self):
        order = np.lexsort((self.own, -self.count))  # dealt to the classes by count, so that each has some common ones
        dealt = np.empty(len(order), np.int64)
        dealt[order] = np.arange(len(order))
        by_hash = np.argsort(self.own)
        self.own, self.count, self.place = self.own[by_hash], self.count[by_hash], self._slot(dealt[by_hash])
        rest = self._slot(len(self.own) + np.arange(len(self.shared)))
        mass, self.log_rest = np.zeros(self.classes * self.members), np.zeros(self.classes * self.members)
        mass[self.place], mass[rest] = self.count, self.shared
        self.log_rest[rest] = np.log10(self.shared + self.kinds + 1.0)
        mass = (mass + 0.5) / (mass + 0.5).sum()
        self.class_p = mass.reshape(self.classes, -1).sum(1)
        self.member_p = (mass.reshape(self.classes, -1) / self.class_p[:, None]).ravel()
        self.class_cum = np.cumsum(self.class_p)
        self.starts = np.searchsorted(self.own >> np.uint64(64 - DIRECTORY), np.arange((1 << DIRECTORY) + 1, dtype=np.uint64))
        self.deepest = int(np.diff(self.starts).max())
        self.before = int(self.places(np.array([END]))[0][0])

    def _slot(self, dealt: np.ndarray) -> np.ndarray:
        return dealt % self.classes * self.members + dealt // self.classes

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each token, and its count where it has the slot for its own (else 0)."""
        out = self._slot(len(self.own) + ((h >> np.uint64(40)) % np.uint64(len(self.shared))).astype(np.int64))
        count = np.zeros(len(h), np.int64)
        if len(self.own):
            first = self.starts.take((h >> np.uint64(64 - DIRECTORY)).view(np.int64))
            for i in range(self.deepest):
                at = np.minimum(first + i, len(self.own) - 1)
                mine = np.flatnonzero(self.own.take(at) == h)
                at = at[mine]
                out[mine], count[mine] = self.place[at], self.count[at]
        return out, count

    def start(self) -> list[np.ndarray]:
        """Vectors of contexts, members, classes and positions: small, at the unigram model. An end precedes each text.

        Members' and classes' last entries are biases.
        """
        rng = np.random.default_rng(7)
        small = lambda n: rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32)
        biased = lambda p: np.concatenate([small(len(p)), np.log(p)[:, None].astype(np.float32)], 1)
        return [small(len(self.member_p)), biased(self.member_p), biased(self.class_p), np.ones((2, WIDTH), np.float32)]


def _before(place: np.ndarray, bounds: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of every token: the one before it and the one before that."""
    one, two = np.full(len(place), start), np.full(len(place), start)
    one[1:], two[2:] = place[:-1], place[:-2]
    one[bounds[:-1]] = start
    two[bounds[:-1]] = start
    two[bounds[:-1][np.diff(bounds) > 1] + 1] = start
    return one, two


def _begins(x: np.ndarray) -> np.ndarray:
    """Where the stretches of equal values of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def _summed(rows: np.ndarray, order: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the stretches of `rows[order]` that begin at `at`; most are of a few rows."""
    n = np.diff(np.append(at, len(order)))
    out = rows.take(order[at], axis=0)
    for i in range(1, SHORT):
        more = np.flatnonzero((n > i) & (n <= SHORT))
        out[more] += rows.take(order[at[more] + i], axis=0)
    long = n > SHORT
    if long.any():
        sizes = n[long]
        out[long] = np.add.reduceat(rows.take(order[np.repeat(long, n)], axis=0), np.cumsum(sizes) - sizes)
    return out


def _move(x: np.ndarray, power: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """AdaGrad step of the indexed rows by their summed gradients."""
    order = np.argsort(index.astype(np.uint16) if len(x) <= 1 << 16 else index, kind="stable")  # short keys sort by digits
    index = index.take(order)
    at = _begins(index)
    g, k = _summed(rows, order, at), index[at]
    s = power.take(k, axis=0)
    s += g * g
    whole = np.dtype((np.void, x.itemsize * x.shape[1]))  # rows are written as one item each
    power.view(whole)[k, 0] = s.view(whole)[:, 0]
    np.sqrt(s, out=s)
    g *= np.float32(RATE)
    g /= s
    g += x.take(k, axis=0)
    x.view(whole)[k, 0] = g.view(whole)[:, 0]


def _sure(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in place."""
    np.exp(x, out=x)  # beyond the largest float the result is 0
    x += 1
    return np.reciprocal(x, out=x)


def train_block(p: list[np.ndarray], power: list[np.ndarray], space: Space, place, one, two, rng) -> None:
    """One pass over a block, in steps of some stretches of STRETCH tokens in random order.

    A step contrasts the tokens' classes with noise that all of them share and their members with noise that those of a class
    share, and moves every vector once.
    """
    class_odds = np.log(NOISE * space.class_p).astype(np.float32)
    member_odds = np.log(NOISE * space.member_p).astype(np.float32)
    reach = np.cumsum(space.member_p)  # each class adds 1
    order, size = rng.permutation(-(-len(place) // STRETCH)), -(-space.classes * STEP // STRETCH)
    with np.errstate(over="ignore"):
        for i in range(0, len(order), size):
            at = (order[i:i + size, None] * STRETCH + np.arange(STRETCH)).ravel()
            at = at[at < len(place)]
            _step(p, power, space, place[at], one[at], two[at], rng, class_odds, member_odds, reach)


def _step(p, power, space: Space, slot, one, two, rng, class_odds, member_odds, reach) -> None:
    r, members, classes, scale = p
    # A token's context before last is mostly the last one of the token before it: those are read and moved once.
    fresh = np.flatnonzero(np.concatenate([[True], two[1:] != one[:-1]]))
    a = r.take(one, axis=0)
    b = np.empty_like(a)
    b[1:] = a[:-1]
    b[fresh] = r.take(two[fresh], axis=0)
    wide = np.ones((len(slot), WIDTH + 1), np.float32)
    wide[:, :-1] = a * scale[0] + b * scale[1]
    order = np.argsort(slot.astype(np.uint16) if len(reach) <= 1 << 16 else slot, kind="stable")
    wide, slot = wide.take(order, axis=0), slot[order]
    own = slot // space.members

    drawn = np.minimum(np.searchsorted(space.class_cum, rng.random(NOISE)), space.classes - 1)
    mine, others = classes.take(own, axis=0), classes[drawn]
    up = _sure(np.einsum("ij,ij->i", wide, mine) - class_odds[own])[:, None]  # how far the data is from certain
    down = wide @ -others.T
    down += class_odds[drawn]
    _sure(down)  # how far noise is from being told
    mine *= up
    mine -= down @ others
    du = mine
    cuts = _begins(own)
    kinds = own[cuts]
    class_rows = np.concatenate([np.add.reduceat(up * wide, cuts), -(down.T @ wide)])

    noise = np.searchsorted(reach, kinds[:, None] + rng.random((len(kinds), NOISE)))
    noise = np.clip(noise, kinds[:, None] * space.members, (kinds[:, None] + 1) * space.members - 1)
    mine, others, odds = members.take(slot, axis=0), members.take(noise, axis=0), member_odds[noise]
    up = _sure(np.einsum("ij,ij->i", wide, mine) - member_odds[slot])[:, None]
    mine *= up
    du += mine
    others *= -1
    away = np.empty_like(others)
    for j, (x, y) in enumerate(zip(cuts.tolist(), [*cuts[1:].tolist(), len(slot)])):
        part, other = wide[x:y], others[j]
        down = part @ other.T
        down += odds[j]
        _sure(down)
        du[x:y] += down @ other
        np.matmul(down.T, part, out=away[j])
    np.negative(away, out=away)
    met = _begins(slot)

    _move(classes, power[2], np.concatenate([kinds, drawn]), class_rows)
    _move(members, power[1], np.concatenate([slot[met], noise.ravel()]),
          np.concatenate([_summed(up * wide, np.arange(len(slot)), met), away.reshape(-1, WIDTH + 1)]))
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    du = du[:, :-1].take(back, axis=0)
    ds = np.stack([np.einsum("ij,ij->j", du, a), np.einsum("ij,ij->j", du, b)])
    late = du * scale[1]
    du *= scale[0]
    first = late[fresh]
    late[fresh] = 0
    du[:-1] += late[1:]
    _move(r, power[0], np.concatenate([one, two[fresh]]), np.concatenate([du, first]))
    power[3][:] += ds * ds
    scale[:] += RATE * ds / np.sqrt(power[3])


VECTORS = "kind int, id long, w double, x array<float>"


def train(batches, space: Space, first: list[np.ndarray]):
    """One pass over a task's texts; the vectors it moved, with the steps that moved each as weight."""
    def anew():
        return ([x.copy() for x in first], [np.full(x.shape, 0.1, np.float32) for x in first],
                [np.zeros(len(x)) for x in first], np.random.default_rng(11))

    def flush():
        for kind, (x, w) in enumerate(zip(p, used)):
            at = np.flatnonzero(w)
            x = x[at] if x.shape[1] > WIDTH else np.concatenate([x[at], np.zeros((len(at), 1), np.float32)], 1)
            for a in range(0, len(at), 1 << 14):
                n = len(at[a:a + (1 << 14)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, kind, np.int32)), pa.array(at[a:a + n]), pa.array(w[at[a:a + n]]),
                    lists(x[a:a + n].ravel(), np.arange(n + 1) * (WIDTH + 1), pa.float32())], names=["kind", "id", "w", "x"])

    (p, power, used, rng), done = anew(), 0
    for batch in batches:
        for part in blocks(batch):
            h, bounds = _tokens(part.column("text"))
            place, _ = space.places(h)
            one, two = _before(place, bounds, space.before)
            train_block(p, power, space, place, one, two, rng)
            used[MEMBER] += np.bincount(place, minlength=len(used[MEMBER]))
            used[CONTEXT] += np.bincount(one, minlength=len(used[CONTEXT])) + np.bincount(two, minlength=len(used[CONTEXT]))
            used[CLASS] += len(place)
            used[SCALE] += len(place)
            done += len(place)
            if done >= HANDOVER:
                yield from flush()
                (p, power, used, rng), done = anew(), 0
    if done:
        yield from flush()


def _softmax_log10(context: np.ndarray, matrix: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """log10 of the normalised probability of the chosen row of `matrix` (bias last) in each context."""
    turned, bias = np.ascontiguousarray(matrix[:, :-1].T), matrix[:, -1]
    top = bias.max()
    share = np.exp(bias - top)
    mine = np.einsum("ij,ij->i", context, matrix[:, :-1].take(chosen, axis=0)) + (bias[chosen] - top)
    total = np.empty(len(context), np.float32)
    with np.errstate(over="ignore"):
        for a in range(0, len(context), ROWS):  # few enough for the caches
            s = context[a:a + ROWS] @ turned
            np.matmul(np.exp(s, out=s), share, out=total[a:a + ROWS])
    out = mine.astype(np.float64) - np.log(np.maximum(total, np.finfo(np.float32).tiny).astype(np.float64))
    far = np.flatnonzero(~((total > 1e-25) & (total < 1e25)))
    for a in range(0, len(far), ROWS):  # sums near the ends of a float's range, taken from their largest part
        at = far[a:a + ROWS]
        s = context[at].astype(np.float64) @ turned.astype(np.float64) + (bias - top)
        out[at] = s[np.arange(len(at)), chosen[at]] - s.max(1) - np.log(np.exp(s - s.max(1, keepdims=True)).sum(1))
    return out / np.log(10)


def slot_log10(p: list[np.ndarray], space: Space, place, one, two) -> np.ndarray:
    """log10 of the probability of each token's slot: its class, and its place inside."""
    r, members, classes, scale = p
    own, out = place // space.members, np.empty(len(place), np.float64)
    order = np.argsort(own.astype(np.uint16), kind="stable")
    own, inside = own[order], place[order] % space.members
    context = r.take(one[order], axis=0) * scale[0]
    context += r.take(two[order], axis=0) * scale[1]
    logs = _softmax_log10(context, classes, own)
    cuts = np.searchsorted(own, np.arange(space.classes + 1))
    for c in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[c], cuts[c + 1])
        logs[part] += _softmax_log10(context[part], members[c * space.members:(c + 1) * space.members], inside[part])
    out[order] = logs
    return out


def score(batches, space: Space, p: list[np.ndarray], total: int):
    """Per text what the tokens with slots of their own give, and the hashes of all others, repeats included."""
    for batch in batches:
        for part in blocks(batch):
            h, bounds = _tokens(part.column("text"))
            place, count = space.places(h)
            one, two = _before(place, bounds, space.before)
            logs = np.concatenate([slot_log10(p, space, place[a:a + TOKENS], one[a:a + TOKENS], two[a:a + TOKENS])
                                   for a in range(0, len(place), TOKENS)])
            tail = count == 0
            add = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  each text has its end at least
            yield pa.RecordBatch.from_arrays([
                part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(bounds)),
                pa.array(add((~tail).astype(np.int64))), pa.array(add(np.log10((count + 1.0) / total))),
                pa.array(add(logs - space.log_rest[place])),
                lists(h[tail].view(np.int64), np.concatenate([[0], np.cumsum(tail)])[bounds], pa.int64()),
            ], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "tail"])


@dataclass
class Model:
    space: Space
    vectors: list[np.ndarray]
    #: Training tokens, distinct ones, and the table (h, c) of those that share slots.
    n: int
    v: int
    rest: DataFrame


def fit(texts: DataFrame, slots: int = SLOTS, min_count: int = MIN_COUNT, rounds: int = ROUNDS) -> Model:
    """The model of a frame with the column `text`."""
    spark = texts.sparkSession
    counts = cut_lineage(texts.mapInArrow(_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # Tokens from the commonest down by parts of an octave, as many whole parts as there are slots for.
    step, often = F.floor(F.log2("c") * OCTAVE), F.col("c") >= min_count
    sizes = counts.where(often).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 64 octaves
    least, taken = None, 0
    for s in sorted(sizes, key=lambda s: -s["step"]):
        if taken + s["n"] > slots * OWN_SHARE:
            break
        least, taken = s["step"], taken + s["n"]
    mine = often & (step >= least) if least is not None else F.lit(False)
    own = counts.where(mine).toArrow()  # at most OWN_SHARE of the slots
    rest = counts.where(~mine)
    bits = min(int(np.log2(slots)), max(4, int(np.ceil(np.log2(max(taken, sums["v"] / 8, 1) / OWN_SHARE + 1)))))
    classes, members = 1 << (bits + 1) // 2, 1 << bits // 2
    free = classes * members - taken
    shared, kinds = np.zeros(free), np.zeros(free)
    parts = rest.groupBy((F.shiftrightunsigned("h", 40) % free).alias("slot")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).toArrow()
    at = parts.column("slot").to_numpy().astype(np.int64)
    shared[at], kinds[at] = parts.column("c").to_numpy(), parts.column("n").to_numpy()
    space = Space(own.column("h").to_numpy().view(np.uint64).copy(), own.column("c").to_numpy().copy(), classes, members, shared, kinds)

    p = space.start()
    for _ in range(rounds):
        given = spark.sparkContext.broadcast((space, p))  # of bounded size
        moved = texts.mapInArrow(lambda batches, given=given: train(batches, *given.value), VECTORS)
        means = [F.sum(F.col("w") * F.col("x")[j]) / F.sum("w") for j in range(WIDTH + 1)]
        learnt = moved.groupBy("kind", "id").agg(F.array(*means).cast("array<float>").alias("x")).toArrow()
        p = [x.copy() for x in p]
        if learnt.num_rows:
            kind, at = learnt.column("kind").to_numpy(), learnt.column("id").to_numpy()
            x = learnt.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH + 1)
            for k in range(len(p)):
                p[k][at[kind == k]] = x[kind == k][:, :p[k].shape[1]]
    return Model(space, p, sums["n"], sums["v"], rest)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, min_count: int = MIN_COUNT,
                rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document, one row per row.

    Documents whose crc32 of the id as text is HELD_OUT modulo FOLDS are scored but not learnt from. A null text counts
    as empty and is its end token; a null id counts as the empty text for the fold; repeated rows count each. An empty
    table gives no rows, one without training documents the uniform scores of no counts; further columns are ignored.
    """
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), (fold == HELD_OUT).alias("held_out"), F.col(text_col).alias("text"))
    model = fit(rows.where("not held_out").select("text"), slots, min_count, rounds)
    kind, total = rows.schema["doc_id"].dataType.simpleString(), model.n + model.v + 1
    given = docs.sparkSession.sparkContext.broadcast((model.space, model.vectors))  # of bounded size
    scored = cut_lineage(rows.mapInArrow(
        lambda batches: score(batches, *given.value, total),
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, tail array<long>"))
    # What training texts never hold adds nothing to either sum; the others are no hot keys, being rare in training.
    met = scored.select("row", F.explode("tail").alias("h")).join(model.rest, "h").groupBy("row").agg(
        F.count(F.lit(1)).alias("_known"), F.sum(F.log10(F.col("c") + 1.0)).alias("_more"))
    more = F.coalesce("_more", F.lit(0.0))
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"))
