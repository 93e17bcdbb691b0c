"""Repeated passages: paragraphs cut by content, MinHash banding, exact checks, components, removal of the copies.

A passage is pasted into running text as often as it stands on lines of its own, so a paragraph here is any
window of ``GRAM + BAND - 1`` = 24 words, wherever it starts. Its key is the least hash of the ``BAND`` runs of ``GRAM`` words in
it: one minimum, one band. Neighbours mostly share their key, so a text has one key about every 6 words. Equal
windows have equal keys, whatever stands around them. A near copy of 51 words or more at a similarity of 0.8 has at most one changed
word for every 45, so some 24 words in a row are unchanged and at least one key is the same: the band loses no such pair.

* Texts with equal words are one text, held by the smallest id; the other ones are repeated from end to end.
* A key that several texts have is joined with its first place, by (id, place); that text is the *hub* of the key.
* The keys that a text shares with one hub on about the same diagonal are a chain. The words of a chain and ``MARGIN`` words
  before and after it meet the hub's text, are extended word by word across single changed words, and pass if both sides have
  ``min_words`` words and their sets of five-word shingles an exact Jaccard similarity of ``percent`` or more.
  A chain that fails is tried again in pieces without a gap.
* A key that comes again within a text is joined with the place before it, and checked the same way, in the same task.
  Where its places overlap at the same distance (a run of one word, or of a few in turn), the two first and the two last of them go on:
  two such stretches agree on most words where they begin or end together, and what is inside one repeats its own first turn.
* A key of three or more places is then looked at again, at every place of it: two places meet unless the later one is removed already and
  both are in one component. Their words, ``CONTEXT`` on either side, are compared in blocks of at most two times ``BLOCK`` places inside tasks: first
  by the equal words around the key, of which every similar pair has a key with ``GRAM + BAND - 1``, then by the different shingles
  that both have, of which a span needs most of the fewest in any ``min_words`` words, then as above. Only links come out.
* Verified spans that overlap in a text are one passage; passages are the nodes and verified pairs the links of components. Every span
  that has an earlier equal is removed; ``first_`` is the document of the component's first passage, which stays.

A task holds a text and at most ``MASS`` bytes of chains (or one chain): a hub that many texts share is dealt to many tasks. Words are
told by 32 bits of their hash in checks, texts by 64 bits, keys by 64 bits.

So two texts are compared also if all runs of 13 words of their passage stand, in pieces of under 51 words, in earlier texts. The
pairs of places of a short piece that very many texts share, and nothing around it, grow with the square of these texts.

Defined results: null and empty texts, and those under ``min_words`` words, have no passages; rows without an id are not looked at;
rows that share an id are texts of their own, whose spans are all told under that id; a row that is there twice is a copy of itself and told once;
words of any length and texts of any length are taken whole; a text that repeats itself keeps the first turn; empty tables give no rows.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabwright.llm.components import connected_components
from tabwright.llm.neardup import bounded
from tabwright.llm.tokens import ODD, WORD, free_name, mixed, shingle_hashes, word_hashes
from tabwright.operators.skew import spread_left_join
from tabwright.sources.durable import drop_copy, materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 13  # words of the runs whose least hash is a key
BAND = 12  # runs that a key is the least of; two neighbouring keys of equal texts leave no word between them
GAP = 48  # most words between two keys of a chain: one changed word takes up to 36
SHIFT = 8  # most words by which a chain may leave its diagonal at one gap
MARGIN = 64  # words before and after a chain that travel with it
CHANGED = 20  # words that must follow a changed one for a span to go on across it
MASS = 1 << 20  # bytes of chains that one task holds beside a hub's text
CONTEXT = 128  # words before and after a key that travel with it to the blocks
BLOCK = 1024  # places of a key in one half of a block
OPEN = 4096  # about the pairs of places of a block that are looked at at a time
LEAST, PAIRS = 16, 512  # fewest and most pairs that are compared at a time
SPANS = 4096  # most spans that are extended at a time
HUBS = 100_000  # most hubs (20 bytes each) in a broadcast; beyond it only those of heavy keys are


@dataclass(frozen=True)
class Passages:
    shingle: int = 5
    percent: int = 80
    min_words: int = 51


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One uint64 per run of ``size`` words, of two overlapping runs of a power of two, each of two halves."""
    hashes, width = words, 1
    while 2 * width <= size:
        hashes = mixed(hashes[:-width] * ODD[0] + hashes[width:] * ODD[1])
        width *= 2
    rest = size - width
    return mixed(hashes[:len(hashes) - rest] * ODD[2] + hashes[rest:] * ODD[3])


def _sliding(best: np.ufunc, values: np.ndarray, size: int) -> np.ndarray:
    """The least or greatest of each ``size`` values in a row."""
    width = 1
    while width < size:
        step = min(width, size - width)
        values = best(values[:-step], values[step:])
        width += step
    return values


def keys_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of the runs that are the least of some window; equal least ones all count."""
    if len(words) < GRAM + BAND - 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    runs = run_hashes(words, GRAM)
    least = np.zeros(len(runs) + BAND - 1, np.uint64)
    least[BAND - 1: len(runs)] = _sliding(np.minimum, runs, BAND)
    places = np.flatnonzero(_sliding(np.maximum, least, BAND) == runs)
    return places, runs[places]


def outer_places(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the sorted (key, place) are not inside a stretch of overlapping places at the same distance: all but its two first and last."""
    step = np.where(keys[1:] == keys[:-1], np.diff(places), GRAM)
    same = (step[1:] == step[:-1]) & (step[1:] < GRAM)  # of each place but the first and last: that it has one before and one after it
    inner = np.zeros(len(places), bool)
    inner[2:-2] = same[:-2] & same[1:-1] & same[2:]
    return ~inner


def text_digest(words: np.ndarray) -> int:
    place = np.arange(len(words), dtype=np.uint64)
    return int(mixed(mixed(words + place * ODD[30]).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def _extent(wrong: list[int], place: int, way: int, n: int) -> int:
    """How far at most ``n`` words from ``place`` on, or before it, go on alike but for those at ``wrong``; a changed word counts as ``CHANGED`` equal ones."""
    score = best = top = at = 0
    i = bisect_left(wrong, place) - (way < 0)
    while score + n - at > top:
        k = n
        if 0 <= i < len(wrong):
            k = min(n, wrong[i] - place if way > 0 else place - 1 - wrong[i])
        score += k - at
        if score > top:
            best, top = k, score
        score, at = score - CHANGED, k + 1
        i += way
    return best


def similar(x: np.ndarray, y: np.ndarray, plan: Passages) -> bool:
    if len(x) == len(y) and (x == y).all():
        return True
    return alike_sets(*(set(shingle_hashes(z.astype(np.uint64), plan.shingle).tolist()) for z in (x, y)), plan)


def alike_sets(x: set, y: set, plan: Passages) -> bool:
    if min(len(x), len(y)) * 100 < max(len(x), len(y)) * plan.percent:
        return False
    both = len(x & y)
    return both * 100 >= (len(x) + len(y) - both) * plan.percent


def _grown(x, y, at, first, last, plan, changed):
    """The verified span around the keys from ``first`` to ``last``, each a (place, place in y); else None. x starts at ``at``.

    ``changed`` remembers the changed words of a diagonal.
    """
    (p, q), (p_end, q_end) = first, (last[0] + GRAM, last[1] + GRAM)
    wrong = changed(p - q)
    before = _extent(wrong, p, -1, min(p - at, q, MARGIN))
    if p_end - q_end != p - q:
        wrong = changed(p_end - q_end)
    after = _extent(wrong, p_end, 1, min(at + len(x) - p_end, len(y) - q_end, MARGIN))
    span = p - before, p_end + after, q - before, q_end + after
    if min(span[1] - span[0], span[3] - span[2]) < plan.min_words:
        return None
    return span if similar(x[span[0] - at: span[1] - at], y[span[2]: span[3]], plan) else None


def verified(x: np.ndarray, y: np.ndarray, at: int, p: np.ndarray, q: np.ndarray, plan: Passages) -> list[tuple]:
    """Spans (start, stop, start in y, stop in y) that a chain of shared keys proves; x holds the words from ``at`` on."""
    found: dict[int, list[int]] = {}
    lean = p - q

    def changed(on: int) -> list[int]:
        """Places in x of the words around the chain's keys on a diagonal that are others in y."""
        if on not in found:
            mine = p[lean == on]
            low = max(at, on, int(mine[0]) - MARGIN)
            high = min(at + len(x), on + len(y), int(mine[-1]) + GRAM + MARGIN)
            found[on] = ((x[low - at: high - at] != y[low - on: high - on]).nonzero()[0] + low).tolist()
        return found[on]

    ends = (int(p[0]), int(q[0])), (int(p[-1]), int(q[-1]))
    whole = _grown(x, y, at, *ends, plan, changed)
    cuts = np.flatnonzero((p[1:] - p[:-1] > BAND) | (lean[1:] != lean[:-1])) + 1
    if whole or not len(cuts):
        return [whole] if whole else []
    edges = [0, *cuts.tolist(), len(p)]
    starts, stops = (list(zip(p[e].tolist(), q[e].tolist())) for e in (edges[:-1], [e - 1 for e in edges[1:]]))
    pieces = [_grown(x, y, at, first, last, plan, changed) for first, last in zip(starts, stops)]
    return [span for span in pieces if span]


def chains(p: np.ndarray, y: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of shared keys by text, diagonal and place, and the first of each chain with at last their number."""
    order = np.lexsort((p, y))
    p, y, q = p[order], y[order], q[order]
    step, other = p[1:] - p[:-1], q[1:] - q[:-1]
    far = (y[1:] != y[:-1]) | (step > GAP) | (np.abs(step - other) > SHIFT) | (other < 0)
    return order, np.concatenate([[0], np.flatnonzero(far) + 1, [len(p)]]) if len(p) else np.zeros(1, np.int64)


def _texts(column: pa.Array):
    """Texts as bytes, one at a time."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def _profiles(plan: Passages, batches):
    """(id, digest, n, twice, keys, places): the outer places of each key, in their order; ``twice`` if a key comes again."""
    for batch in batches:
        numbers, digests, sizes, twice, keys, places = [], [], [], [], [], []
        for number, text in enumerate(_texts(batch.column("text"))):
            words = word_hashes(text, lower=True)
            if len(words) < plan.min_words:
                continue
            place, key = keys_of(words)
            order = np.argsort(key, kind="stable")
            numbers.append(number)
            digests.append(text_digest(words))
            sizes.append(len(words))
            twice.append(len(np.unique(key)) < len(place))
            place, key = place[order], key[order]
            outer = outer_places(place, key)
            keys.append(key[outer].view(np.int64))
            places.append(place[outer].astype(np.int32))
        if numbers:
            ends = pa.array(np.cumsum([0, *map(len, keys)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(numbers)), pa.array(digests, pa.int64()), pa.array(sizes, pa.int32()), pa.array(twice),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys))),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(places))),
            ], names=["id", "digest", "n", "twice", "keys", "places"])


CHAIN = "x long, y long, start int, stop int, y_start int, y_stop int, at int, p binary, q binary, words binary"
SPAN = CHAIN.split(", at")[0]


def _chain_rows(plan: Passages, batches):
    """Chains with other texts and their words, and verified spans within the text, which have no words."""
    for batch in batches:
        rows = []
        lists, wanted = batch.column("met"), batch.column("digest").to_pylist()
        ends, met = lists.offsets.to_numpy(), lists.values
        all_p, all_y, all_q = (met.field(k).to_numpy() for k in range(3))
        for k, text in enumerate(_texts(batch.column("text"))):
            words = word_hashes(text, lower=True)
            own = wanted[k]
            if len(words) < plan.min_words or text_digest(words) != own:  # another text under the same id
                continue
            short = (words >> np.uint64(32)).astype(np.uint32)
            at, end = ends[k], ends[k + 1]
            p, y, q = all_p[at:end].astype(np.int64), all_y[at:end], all_q[at:end].astype(np.int64)
            order, edges = chains(p, y, q)
            for i, j in zip(edges, edges[1:]):
                mine = order[i:j]
                low, high = max(0, int(p[mine[0]]) - MARGIN), int(p[mine[-1]]) + GRAM + MARGIN
                rows.append((own, int(y[mine[0]]), None, None, None, None, low, p[mine].astype(np.int32).tobytes(),
                             q[mine].astype(np.int32).tobytes(), short[low:high].tobytes()))
            place, key = keys_of(words)
            order = np.argsort(key, kind="stable")
            again = np.flatnonzero(key[order][1:] == key[order][:-1])
            p, q = place[order[again + 1]], place[order[again]]
            order, edges = chains(p, np.zeros(len(p), np.int64), q)
            for i, j in zip(edges, edges[1:]):
                for span in verified(short, short, 0, p[order[i:j]], q[order[i:j]], plan):
                    rows.append((own, own, *span, None, None, None, None))
        if rows:
            yield _batch(rows, CHAIN)


def _spans(plan: Passages, batches):
    """Verified spans of the chains that meet a hub."""
    for batch in batches:
        rows = []
        for text, hub, chain in zip(_texts(batch.column("text")), batch.column("digest").to_pylist(), batch.column("chains")):
            words = word_hashes(text, lower=True)
            if text_digest(words) != hub:
                continue
            short = (words >> np.uint64(32)).astype(np.uint32)
            for own in chain.as_py():
                p, q = (np.frombuffer(own[c], np.int32) for c in "pq")
                for span in verified(np.frombuffer(own["words"], np.uint32), short, own["at"], p, q, plan):
                    rows.append((own["x"], hub, *span))
        if rows:
            yield _batch(rows, SPAN)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _with_run(spans: DataFrame, key: str) -> DataFrame:
    """``run`` is the same number for spans of a key that overlap or touch."""
    before = Window.partitionBy(key).orderBy("start", "stop")
    opens = F.coalesce(F.col("start") > F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    return spans.withColumn("opens", opens.cast("int")) \
        .withColumn("run", F.sum("opens").over(before.rowsBetween(Window.unboundedPreceding, 0))).drop("opens")


def merged_spans(spans: DataFrame) -> DataFrame:
    """(id, start, stop, n, first) out of spans that may overlap or touch; ``n`` counts them."""
    return _with_run(spans, "id").groupBy("id", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n").alias("n"),
        F.min_by("first", F.struct("start", "stop", "first")).alias("first")).drop("run")


def _shared(firsts: DataFrame) -> DataFrame:
    """Stored (id, digest, key, place, is_first) of the keys that have several texts or more than two places; is_first in its text."""
    listed = firsts.select("id", "digest", F.posexplode(F.arrays_zip("keys", "places")).alias("at", "k"), "keys")
    seeds = listed.select("id", "digest", F.col("k.keys").alias("key"), F.col("k.places").alias("place"),
                          ((F.col("at") == 0) | (F.get("keys", F.col("at") - 1) != F.col("k.keys"))).alias("is_first"))
    met = materialise(seeds.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_first").alias("texts"))
                      .where("texts > 1 OR n > 2").select("key"))
    shared = materialise(seeds.join(bounded(met), "key", "left_semi"))
    drop_copy(met)
    return shared


def _candidates(shared: DataFrame) -> DataFrame:
    """(digest, met): for each text its keys' (place, hub, place in the hub), as far as another text is the hub."""
    shared = shared.where("is_first")
    hubs = materialise(shared.groupBy("key").agg(F.min(F.struct("id", "digest", "place")).alias("hub"))
                       .select("key", F.col("hub.digest").alias("y"), F.col("hub.place").alias("q")))
    if hubs.count() <= HUBS:
        joined = shared.join(F.broadcast(hubs), "key")
    else:
        joined = spread_left_join(shared.withColumnRenamed("key", "of"), hubs, {"key": F.col("of")})
    lists = materialise(joined.where("digest <> y").groupBy("digest").agg(F.collect_list(F.struct("place", "y", "q")).alias("met")))
    drop_copy(hubs)
    return lists


def _named(links: DataFrame) -> DataFrame:
    """Stored (digest, start, stop, node, component): the sides of the links, the passage and the component that each is in."""
    sides = links.select(F.col("x").alias("digest"), "start", "stop").union(links.select("y", "y_start", "y_stop")).distinct()
    runs = materialise(_with_run(sides, "digest").select("digest", "start", "stop", F.xxhash64("digest", "run").alias("node")))
    x = runs.select(F.col("digest").alias("x"), "start", "stop", F.col("node").alias("a"))
    y = runs.select(F.col("digest").alias("y"), F.col("start").alias("y_start"), F.col("stop").alias("y_stop"), F.col("node").alias("b"))
    pairs = links.join(bounded(x), ["x", "start", "stop"]).join(bounded(y), ["y", "y_start", "y_stop"])
    labels = connected_components(pairs.select("a", "b"))
    named = materialise(runs.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
    drop_copy(runs)
    return named


def _open_places(shared: DataFrame, links: DataFrame) -> DataFrame:
    """Stored (id, digest, key, place, cls, told): the places of keys of which two may still have to meet.

    ``cls`` is the component of the passage around the place, ``told`` if a span around it has an earlier equal.
    """
    named = _named(links)
    own = named.groupBy("digest", "node", "component").agg(F.min("start").alias("at"), F.max("stop").alias("stop"))
    gone = _with_run(links.select(F.col("x").alias("digest"), "start", "stop").distinct(), "digest") \
        .groupBy("digest", "run").agg(F.min("start").alias("at"), F.max("stop").alias("gone"))
    marks = own.select("digest", "at", F.struct("stop", "component").alias("own")).unionByName(gone.drop("run"), allowMissingColumns=True)
    line = Window.partitionBy("digest").orderBy("at", F.col("key").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("at") + GRAM
    placed = materialise(
        shared.select("id", "digest", "key", F.col("place").alias("at")).unionByName(marks, allowMissingColumns=True)
        .withColumns({c: F.last(c, ignorenulls=True).over(line) for c in ("own", "gone")}).where("key IS NOT NULL")
        .select("id", "digest", "key", F.col("at").alias("place"), F.when(F.col("own.stop") >= end, F.col("own.component")).alias("cls"),
                F.coalesce(F.col("gone") >= end, F.lit(False)).alias("told")))
    drop_copy(named)
    first = F.min(F.struct("id", "digest", "place", "told")).alias("first")
    keys = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count("cls").alias("in_one"), F.min("cls").alias("lo"), F.max("cls").alias("hi"),
        F.count_if(~F.col("told")).alias("left"), first)
    some = materialise(keys.where("n > 2 AND (in_one < n OR lo <> hi OR left > IF(first.told, 0, 1))").select("key"))
    found = materialise(placed.join(bounded(some), "key"))
    drop_copy(placed)
    drop_copy(some)
    return found


def _contexts(plan: Passages, kind: pa.DataType, batches):
    """(id, digest, key, place, cls, told, at, words): each open place with the words around it."""
    def batch_of(rows):
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "digest", "key", "place", "cls", "told", "at", "words"]
    types = [kind, pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
    for batch in batches:
        rows = []
        ids, wanted, met = batch.column("id").to_pylist(), batch.column("digest").to_pylist(), batch.column("met")
        ends, fields = met.offsets.to_pylist(), [met.values.field(c).to_pylist() for c in ("key", "place", "cls", "told")]
        for k, text in enumerate(_texts(batch.column("text"))):
            words = word_hashes(text, lower=True)
            if len(words) < plan.min_words or text_digest(words) != wanted[k]:
                continue
            short = (words >> np.uint64(32)).astype(np.uint32)
            for key, place, cls, told in zip(*(f[ends[k]: ends[k + 1]] for f in fields)):
                at = max(0, place - CONTEXT)
                rows.append((ids[k], wanted[k], key, place, cls, told, at, short[at: place + GRAM + CONTEXT].tobytes()))
                if len(rows) >= 4 * BLOCK:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)


def _alike(equal: np.ndarray) -> np.ndarray:
    """For each row, how far ``_extent`` goes on."""
    score = np.cumsum(np.where(equal, 1, -CHANGED).astype(np.int32), axis=1)
    best = score.argmax(axis=1)
    return np.where(score[np.arange(len(score)), best] > 0, best + 1, 0)


def _equal(rows: np.ndarray) -> np.ndarray:
    """For each row, how many are equal before the first other one."""
    return np.where(rows.all(axis=1), rows.shape[1], rows.argmin(axis=1))


def _block_links(plan: Passages, batches):
    """Verified spans of the places of one key, each with the earlier ones that it has to meet; a block is the rows in a row of one (key, lo, hi)."""
    block, places, links = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if (own := (row["key"], row["lo"], row["hi"])) != block:
                links += _block(places, block and block[1] != block[2], plan)
                block, places = own, []
            places.append(row)
        if links:
            yield _batch(links, SPAN)
            links = []
    if links := _block(places, block and block[1] != block[2], plan):
        yield _batch(links, SPAN)


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers from each start to its stop, one range after the other."""
    sizes = stop - start
    return np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _in_each(hashed, words: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the runs of ``size`` words inside each of some lists of as many words or more, whose each is, and where each list's begin."""
    sizes = np.array([len(w) for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    hashes = hashed(np.concatenate(words).astype(np.uint64))
    whole = owner[size - 1:] == owner[:len(hashes)]
    return hashes[whole], owner[:len(hashes)][whole], np.cumsum([0, *(sizes - size + 1)])


def _changes(values: np.ndarray) -> np.ndarray:
    """Which values are not the one before."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _edges(owner: np.ndarray, m: int) -> np.ndarray:
    """Where the first of each of m owners in order is, and at last their number."""
    edges = np.zeros(m + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=m), out=edges[1:])
    return edges


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the hashes by value, equal ones by place, and in this order the number of each different value."""
    order = np.argsort(hashes)
    found = hashes[order]
    number = np.cumsum(_changes(found)) - 1
    by_place = number * len(order) + order  # faster than a stable order from the start
    by_place.sort()
    return by_place % len(order), number


class _SharedShingles:
    """Shingles that several of some word lists have, and the fewest different ones that ``min_words`` words of a list have."""

    def __init__(self, words: list[np.ndarray], plan: Passages):
        m, size = len(words), plan.min_words - plan.shingle + 1
        hashes, owner, self.ends = _in_each(partial(shingle_hashes, size=plan.shingle), words, plan.shingle)
        n = len(hashes)
        order, ids = _numbered(hashes)
        by_owner = owner[order]
        self.number = np.empty(n, np.int64)
        self.number[order] = ids
        first = _changes(ids) | _changes(by_owner)  # in its list
        again = np.flatnonzero(~first)
        # a shingle counts for the windows that begin after its place before, at most ``size`` back, and up to itself
        at = np.arange(n)
        opens = np.maximum(self.ends[owner], at - size + 1)
        opens[order[again]] = np.maximum(opens[order[again]], order[again - 1] + 1)
        different = np.cumsum(np.bincount(opens, minlength=n + 1) - np.bincount(at + 1))
        starts = np.flatnonzero(owner[size - 1:] == owner[:max(0, n - size + 1)])
        self.fewest = np.full(m, n + 1)
        np.minimum.at(self.fewest, owner[starts], different[starts])
        number, lists = ids[first], by_owner[first]
        several = np.bincount(number)[number] > 1
        number, self.lists = number[several], lists[several]
        mine = np.argsort(self.lists.astype(np.min_scalar_type(m)), kind="stable")
        stop = np.cumsum(np.bincount(number))
        self.start, self.stop = (stop - np.bincount(number))[number[mine]], mine  # of the lists before it that have a shingle
        self.edges = _edges(self.lists, m)

    def common(self, i: int) -> np.ndarray:
        """For each list before list ``i``, how many different shingles it has in common with it; no number for the others."""
        return self.counts(i, i + 1)[0]

    def counts(self, low: int, high: int) -> np.ndarray:
        """``common`` of each list from ``low`` to before ``high``."""
        m, own = len(self.fewest), slice(self.edges[low], self.edges[high])
        start, stop = self.start[own], self.stop[own]
        row = np.repeat(np.arange(high - low), np.diff(self.edges[low: high + 1]))
        met = np.repeat(row * m, stop - start) + self.lists[_ranges(start, stop)]
        return np.bincount(met, minlength=(high - low) * m).reshape(high - low, m)

    def alike(self, i: np.ndarray, j: np.ndarray, spans: np.ndarray, plan: Passages) -> np.ndarray:
        """Which of the spans (start, stop, start in the other, its stop) of lists i and j have similar sets of shingles."""
        most, less, sets = len(self.number), plan.shingle - 1, []
        for k, start, stop in ((i, spans[:, 0], spans[:, 1]), (j, spans[:, 2], spans[:, 3])):
            start, stop = self.ends[k] + start, self.ends[k] + stop - less
            held = np.repeat(np.arange(len(k)) * most, stop - start) + self.number[_ranges(start, stop)]
            held.sort()
            sets.append(held[_changes(held)])
        every = np.concatenate(sets)
        every.sort()
        both = np.bincount(every[1:][every[1:] == every[:-1]] // most, minlength=len(i))
        return both * 100 >= (np.bincount(every // most, minlength=len(i)) - both) * plan.percent


class _Around:
    """The words around the places of a block, and what pairs (i, j) of them have in common; pairs come in order, as arrays."""

    def __init__(self, places: list[dict], plan: Passages):
        m = len(places)
        self.plan, self.words = plan, [np.frombuffer(r["words"], np.uint32) for r in places]
        self.digests, self.at, place = (np.array([r[c] for r in places], np.int64) for c in ("digest", "at", "place"))
        self.keys = place - self.at  # where the key is in its words
        self.sizes = np.array([len(w) for w in self.words])
        self.starts, self.flat = np.cumsum(self.sizes) - self.sizes, np.concatenate(self.words)
        # words before the key, from it outwards, and after it; what is outside of a text equals nothing
        self.before, self.after = (np.repeat(-1 - np.arange(m, dtype=np.int64)[:, None], CONTEXT, axis=1) for _ in range(2))
        for i, (w, k) in enumerate(zip(self.words, self.keys.tolist())):
            self.before[i, :k] = w[:k][::-1]
            self.after[i, :len(w) - k - GRAM] = w[k + GRAM:]
        self.shared = self.runs = None

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs have equal words around the key for another key at least."""
        most = BAND - 1
        return sum(_equal(words[i, :most] == words[j, :most]) for words in (self.before, self.after)) >= most

    def bounded(self, low: int, high: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs have shingles enough in common: a span has at least the fewest of its side, and most of them are on both."""
        if self.plan.shingle > GRAM:
            return np.ones(len(i), bool)
        self.shared = self.shared or _SharedShingles(self.words, self.plan)
        both, x, y = self.shared.counts(low, high)[i - low, j], self.shared.fewest[i], self.shared.fewest[j]
        return (both * 100 >= np.maximum(x, y) * self.plan.percent) & (both * (100 + self.plan.percent) >= (x + y) * self.plan.percent)

    def met(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        """(k, p, p_last, q, q_last) of the different runs that both sides of pair k have: their first and last places, counted from the key."""
        if self.runs is None:
            hashes, owner, ends = _in_each(partial(run_hashes, size=GRAM), self.words, GRAM)
            order, number = _numbered(hashes)
            owner = owner[order]
            new = _changes(number) | _changes(owner)
            at = np.flatnonzero(new)
            place = order - (ends[:-1] + self.keys)[owner]
            first, last = place[at], place[np.append(at[1:], len(place)) - 1]
            number, owner = number[at], owner[at]
            kept = np.flatnonzero(np.bincount(number)[number] > 1)
            kept = kept[np.argsort(owner[kept].astype(np.min_scalar_type(len(self.words))), kind="stable")]
            edges = _edges(owner[kept], len(self.words))
            self.runs = len(hashes), number[kept], owner[kept] * len(hashes) + number[kept], first[kept], last[kept], edges
        most, number, sought, first, last, edges = self.runs
        start, stop = edges[j], edges[j + 1]
        k, b = np.repeat(np.arange(len(j)), stop - start), _ranges(start, stop)
        wanted = i[k] * most + number[b]
        a = np.searchsorted(sought, wanted)
        same = np.flatnonzero(sought.take(a, mode="clip") == wanted)
        a, b = a[same], b[same]
        return k[same], first[a], last[a], first[b], last[b]

    def extents(self, i: np.ndarray, j: np.ndarray, p: np.ndarray, q: np.ndarray, way: int) -> np.ndarray:
        """``_extent`` from each place p of a list and q of another one on, or before them."""
        if way < 0:
            most = np.minimum(p, q)
            p, q = p - 1, q - 1
        else:
            most = np.minimum(self.sizes[i] - p, self.sizes[j] - q)
        step = np.arange(MARGIN)
        x, y = (self.flat.take(at[:, None] + way * step, mode="clip") for at in (self.starts[i] + p, self.starts[j] + q))
        return _alike((x == y) & (step < most[:, None]))

    def spans(self, i: np.ndarray, j: np.ndarray) -> list[tuple]:
        """(k, span) of the spans that the shared runs of each pair k prove, as ``verified`` does."""
        long = _alike(self.before[i] == self.before[j]) + _alike(self.after[i] == self.after[j]) + GRAM >= self.plan.min_words
        k, p, p_last, q, q_last = self.met(i, j)
        # off the key's diagonal only another run of words may help
        useful = long | (np.bincount(k[(p != q_last) | (q != p_last)], minlength=len(j)) > 0)
        some, more = useful[k], np.flatnonzero(useful)
        k = np.concatenate([k[some], more])
        p, q = (np.concatenate([c[some], np.zeros(len(more), np.int64)]) for c in (p, q))
        p, q = p + self.keys[i[k]], q + self.keys[j[k]]
        other = (self.digests[i[k]] != self.digests[j[k]]) | (p + self.at[i[k]] != q + self.at[j[k]])
        k, p, q = k[other], p[other], q[other]
        order, edges = chains(p, k, q)
        if len(edges) == 1:
            return []
        k, p, q = k[order], p[order], q[order]
        cut = _changes(p - q)
        cut[1:] |= p[1:] - p[:-1] > BAND
        cut[edges[:-1]] = True
        pieces = np.flatnonzero(cut)
        chain = np.searchsorted(edges, pieces, side="right") - 1
        several = np.bincount(chain)[chain] > 1
        # of each chain the whole, and then its pieces if there are several
        stops = np.append(pieces[1:], len(p))
        first, last = np.concatenate([edges[:-1], pieces[several]]), np.concatenate([edges[1:], stops[several]]) - 1
        chain = np.concatenate([np.arange(len(edges) - 1), chain[several]])
        whole = np.arange(len(chain)) < len(edges) - 1
        found = np.empty((len(first), 4), np.int64)
        for at in range(0, len(first), SPANS):
            a, b = first[at: at + SPANS], last[at: at + SPANS]
            x, y = i[k[a]], j[k[a]]
            before, after = self.extents(x, y, p[a], q[a], -1), self.extents(x, y, p[b] + GRAM, q[b] + GRAM, 1)
            found[at: at + SPANS] = np.stack([p[a] - before, p[b] + GRAM + after, q[a] - before, q[b] + GRAM + after], axis=1)
        some = np.flatnonzero((found[:, 1::2] - found[:, ::2]).min(axis=1) >= self.plan.min_words)
        if not len(some):
            return []
        k = k[first[some]]
        if self.shared:
            proved = self.shared.alike(i[k], j[k], found[some], self.plan)
        else:
            proved = np.array([similar(self.words[i[n]][a:b], self.words[j[n]][c:d], self.plan) for n, (a, b, c, d) in zip(k.tolist(), found[some].tolist())])
        some, k = some[proved], k[proved]
        done = np.zeros(len(edges) - 1, bool)
        done[chain[some[whole[some]]]] = True
        left = whole[some] | ~done[chain[some]]
        some, k = some[left], k[left]
        order = np.argsort(chain[some], kind="stable")
        return list(zip(k[order].tolist(), found[some[order]].tolist()))


def _block(places: list[dict], halves: bool, plan: Passages) -> list[tuple]:
    """``places`` in their order; with ``halves`` only those of different parts meet."""
    if len(places) < 2:
        return []
    m, around = len(places), _Around(places, plan)
    part = np.array([r["part"] for r in places])
    told = np.array([r["told"] for r in places])
    label = {c: k for k, c in enumerate({r["cls"] for r in places} - {None})}
    root = np.array([m + label[r["cls"]] if r["cls"] is not None else i for i, r in enumerate(places)])
    keys, links, low, size = around.keys.tolist(), [], 1, LEAST
    while low < m:
        high = min(m, low + max(1, OPEN // m))
        i, j = np.arange(low, high).repeat(np.arange(low, high)), _ranges(np.zeros(high - low, np.int64), np.arange(low, high))
        keep = ~told[i] | (root[i] != root[j])
        if halves:
            keep &= part[i] != part[j]
        i, j = i[keep], j[keep]
        for meet in (around.near, partial(around.bounded, low, high)):
            if len(i):
                keep = meet(i, j)
                i, j = i[keep], j[keep]
        low = high
        while len(i):
            these, others, pair = i[:size].tolist(), j[:size].tolist(), None
            for k, span in around.spans(i[:size], j[:size]):
                a, b = these[k], others[k]
                if k != pair:
                    pair, over = k, told[a] and root[a] == root[b]
                x, y = places[a], places[b]
                if over or x["digest"] == y["digest"] and span[0] + x["at"] <= span[2] + y["at"]:
                    continue
                links.append((x["digest"], y["digest"], span[0] + x["at"], span[1] + x["at"], span[2] + y["at"], span[3] + y["at"]))
                if span[0] <= keys[a] and keys[a] + GRAM <= span[1] and span[2] <= keys[b] and keys[b] + GRAM <= span[3]:
                    told[a] = True
                    root[root == root[b]] = root[a]
            left = ~told[i] | (root[i] != root[j])
            # a pair that an earlier one makes needless is compared in vain if it comes with it
            i, j, size = i[size:][left[size:]], j[size:][left[size:]], min(2 * size, PAIRS) if left[:size].mean() > 0.5 else LEAST
    return links


def _other_links(own: DataFrame, shared: DataFrame, links: DataFrame, plan: Passages) -> DataFrame:
    """Stored links between the places of keys that the hubs leave open."""
    kind = own.schema["id"].dataType
    open_ = _open_places(shared, links)
    todo = materialise(open_.groupBy("id", "digest").agg(F.collect_list(F.struct("key", "place", "cls", "told")).alias("met")))
    drop_copy(open_)
    some = own.join(bounded(todo.select("id").distinct()), "id", "left_semi")
    around = materialise(some.join(todo, "id").select("id", "text", "digest", "met").mapInArrow(
        partial(_contexts, plan, to_arrow_type(kind)), f"id {kind.simpleString()}, digest long, key long, place int, cls long, told boolean, at int, words binary"))
    drop_copy(todo)
    # removed places of a key with the same words around them, in one component: what the first of them meets, all meet
    alike = ["key", "cls", "told", F.col("place") - F.col("at"), F.when(F.col("told"), F.xxhash64("words")).otherwise(F.xxhash64("digest", "place")), F.md5("words")]
    kept = materialise(around.groupBy(*alike).agg(F.min(F.struct("id", "digest", "place", "at")).alias("f"), F.first("words").alias("words"))
                       .select("key", "cls", "told", "f.*", "words"))
    sizes = kept.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = kept.join(bounded(sizes), "key").withColumn("part", F.pmod(F.xxhash64("digest", "place"), parts).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    block = "key", "lo", "hi"
    rows = dealt.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
                        "id", "digest", "place", "part", "cls", "told", "at", "words")
    blocks = rows.repartition(*block).sortWithinPartitions(*block, "id", "digest", "place")
    found = materialise(blocks.mapInArrow(partial(_block_links, plan), SPAN))
    drop_copy(around)
    drop_copy(kept)
    return found


def _links(own: DataFrame, firsts: DataFrame, plan: Passages) -> DataFrame:
    """Stored, verified (x, start, stop, y, y_start, y_stop): words of text x that text y has at an earlier place."""
    names = firsts.select("id", "digest").distinct()
    shared = _shared(firsts)
    lists = _candidates(shared)
    empty = F.array().cast("array<struct<place:int,y:long,q:int>>")
    todo = materialise(firsts.select("id", "digest", "twice").distinct().join(lists, "digest", "left").where("twice OR met IS NOT NULL")
                       .select("id", "digest", F.coalesce("met", empty).alias("met")))
    drop_copy(lists)
    some = own.join(bounded(todo.select("id").distinct()), "id", "left_semi")
    found = materialise(some.join(todo, "id").select("text", "digest", "met").mapInArrow(partial(_chain_rows, plan), CHAIN))
    drop_copy(todo)
    open_ = found.where("words IS NOT NULL").select("x", "y", "at", "p", "q", "words")
    heavy = open_.groupBy("y").agg(F.ceil(F.sum(F.octet_length("words") + 64) / MASS).cast("int").alias("parts")).where("parts > 1")
    dealt = open_.join(bounded(materialise(heavy)), "y", "left") \
        .withColumn("part", F.pmod(F.xxhash64("x", "at"), F.coalesce("parts", F.lit(1))))
    groups = materialise(dealt.groupBy("y", "part").agg(F.collect_list(F.struct("x", "at", "p", "q", "words")).alias("chains"))
                         .withColumnRenamed("y", "digest").join(names, "digest").select("id", "digest", "chains"))
    hubs = own.join(bounded(groups.select("id").distinct()), "id", "left_semi")
    columns = ["x", "y", "start", "stop", "y_start", "y_stop"]
    spans = hubs.join(groups, "id").select("text", "digest", "chains").mapInArrow(partial(_spans, plan), SPAN)
    links = materialise(spans.union(found.where("words IS NULL").select(*columns)).distinct())
    drop_copy(found)
    drop_copy(groups)
    others = _other_links(own, shared, links, plan)
    drop_copy(shared)
    every = materialise(links.union(others).distinct())
    drop_copy(links)
    drop_copy(others)
    return every


def _told(links: DataFrame, names: DataFrame) -> DataFrame:
    """(digest, id, start, stop, first): each repeated span with the document of its component's first passage."""
    stored = _named(links)
    named = stored.join(names, "digest")
    firsts = named.groupBy("component").agg(F.min(F.struct("id", "start")).alias("first")).select("component", F.col("first.id").alias("first"))
    ends = links.select(F.col("x").alias("digest"), "start", "stop").distinct()
    told = materialise(named.join(ends, ["digest", "start", "stop"], "left_semi").join(bounded(firsts), "component")
                       .select("digest", "id", "start", "stop", "first"))
    drop_copy(stored)
    return told


def all_repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", plan: Passages = Passages()) -> DataFrame:
    """One row per removed passage: (id, start, stop, n_words, n_paragraphs, first id), in words of its document.

    ``n_paragraphs`` counts the verified spans that make up the passage; ``first_`` and the name of ``id`` is the document that
    keeps the first passage of its component.
    """
    own = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("id IS NOT NULL")
    kind = own.schema["id"].dataType.simpleString()
    profile = materialise(own.mapInArrow(
        partial(_profiles, plan), f"id {kind}, digest long, n int, twice boolean, keys array<long>, places array<int>"))
    rows = materialise(profile.groupBy("digest", "id").agg(F.max("n").alias("n")))
    names = materialise(rows.groupBy("digest").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.count(F.lit(1)).alias("times")))
    firsts = materialise(profile.join(names.select("digest", "id"), ["digest", "id"]))
    drop_copy(profile)
    links = _links(own, firsts, plan)
    drop_copy(firsts)
    told = _told(links, names.select("digest", "id"))
    # the other texts with the same words are repeated from end to end
    full = told.where("start = 0").select("digest", "stop", F.col("first").alias("of")) \
        .groupBy("digest", "stop").agg(F.min("of").alias("of")).withColumnRenamed("stop", "n")
    several = materialise(names.where("times > 1").join(full, ["digest", "n"], "left")
                          .select("digest", F.col("id").alias("kept"), F.coalesce("of", "id").alias("first")))
    copies = rows.join(bounded(several), "digest").where("id <> kept") \
        .select("id", F.lit(0).alias("start"), F.col("n").alias("stop"), "first")
    spans = told.select("id", "start", "stop", "first").union(copies).withColumn("n", F.lit(1).cast("long"))
    return merged_spans(spans).select(
        F.col("id").alias(id), "start", "stop", (F.col("stop") - F.col("start")).alias("n_words"), F.col("n").alias("n_paragraphs"),
        F.col("first").alias(f"first_{id}"))


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and the blanks before them."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for start, stop in sorted(spans):
        begin = places[start - 1][1] if start else 0
        kept.append(text[at:begin])
        at = max(at, places[stop - 1][1])
    return b"".join([*kept, text[at:]])


def remove_passages(docs: DataFrame, passages: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the passages cut out of their texts."""
    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([t if not s or t is None else without(t.encode(), [(x["start"], x["stop"]) for x in s]).decode()
                         for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())

    name = free_name(docs, "spans")
    spans = passages.groupBy(F.col(f"`{id}`").alias("id__")).agg(F.collect_list(F.struct("start", "stop")).alias(name))
    joined = docs.join(spans, F.col(f"`{id}`") == F.col("id__"), "left")
    return joined.select(*[cut(F.col(f"`{text}`").cast("string"), F.col(name)).alias(c) if c == text else F.col(f"`{c}`")
                           for c in docs.columns])
