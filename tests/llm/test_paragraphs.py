from __future__ import annotations

import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from tabwright.llm import paragraphs
from tabwright.llm.paragraphs import BAND, GRAM, Passages, all_repeated, keys_of, remove_passages, similar, without
from tabwright.llm.tokens import word_hashes

PLAN = Passages()


def prose(rng, sentences, salt=""):
    return " ".join(" ".join(f"{salt}w{rng.randrange(30_000)}" for _ in range(rng.randrange(3, 20))).capitalize() + rng.choice(".!?")
                    for _ in range(sentences))


def corpus():
    rng = random.Random(4)
    shared = [prose(rng, 7, f"s{k}") for k in range(4)]
    rows = []
    for k in range(120):
        parts = [prose(rng, rng.randrange(1, 9)) for _ in range(3)]
        if k % 3 == 0:
            passage = rng.choice(shared).split(" ")
            if k % 2:
                passage[rng.randrange(len(passage))] = "changed"
            parts.insert(rng.randrange(4), " ".join(passage))
        if k % 4 == 0:
            parts.insert(1, "A line of eight words that all share.")
        rows.append((k, rng.choice([" ", "\n"]).join(parts)))
    return rows + [(200, None), (201, ""), (202, "x. " * 30_000), (203, "word " * 30_000), (204, rows[0][1]), (205, rows[0][1])]


def covered(spans):
    return {(doc, k) for doc, start, stop in spans for k in range(start, stop)}


def brute_windows(rows, size=51):
    """Words of windows that an earlier place has, by looking at all windows."""
    seen, spans = set(), []
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = (text or "").lower().split()
        for k in range(len(words) - size + 1):
            window = tuple(words[k:k + size])
            if window in seen:
                spans.append((doc, k, k + size))
            seen.add(window)
    return covered(spans)


def shingles(words):
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def test_every_pair_of_similar_windows_has_a_key_in_common():
    """By brute force: wherever the changed words stand, as long as the similarity is 0.8 or more."""
    rng = random.Random(5)
    tried = 0
    for _ in range(4000):
        n = rng.randrange(30, 220)
        words = [f"a{rng.randrange(10 ** 6)}" for _ in range(n)]
        near = list(words)
        for k in rng.sample(range(n), rng.randrange(0, 6)):
            near[k] = f"b{k}"
        x, y = shingles(words), shingles(near)
        if 100 * len(x & y) < 80 * len(x | y):
            continue
        tried += 1
        left, right = (set(keys_of(word_hashes(" ".join(["p", *w, "q"]).encode()))[1].tolist()) for w in (words, near))
        assert left & right
    assert tried > 1000


def test_neighbouring_keys_leave_no_word_between_them():
    words = np.random.default_rng(3).integers(0, 1 << 62, 5000, dtype=np.uint64)
    places, keys = keys_of(words)
    assert np.diff(places).max() <= BAND < GRAM and places[0] < BAND and places[-1] > len(words) - GRAM - BAND
    assert len(places) < len(words) / 5 and len(keys) == len(places)
    assert len(keys_of(words[:GRAM + BAND - 2])[0]) == 0 and len(keys_of(words[:GRAM + BAND - 1])[0]) == 1


def test_similarity_is_that_of_the_full_sets():
    rng = random.Random(8)
    for _ in range(300):
        words = [rng.randrange(1 << 20) for _ in range(rng.randrange(5, 90))]
        near = [w if rng.random() > .03 else 7 for w in words][:rng.choice([200, 60])]
        x, y = shingles(words), shingles(near)
        expected = 100 * len(x & y) >= 80 * len(x | y)
        assert similar(np.array(words, np.uint32), np.array(near, np.uint32), PLAN) == expected or len(near) < 5


def test_all_repeated_windows_are_found(spark):
    rng = random.Random(12)
    short = " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(40)}{rng.choice(['.', '!', ''])}" for _ in range(155))
    plain = " ".join(f"p{rng.randrange(9000)}" for _ in range(51))
    rows = corpus()
    rows += [(300 + k, prose(rng, 2) + f" cut{k} " + part + f" rest{k} " + prose(rng, 2)) for k, part in enumerate(
        [short, short.replace(" ", "\n"), plain, plain, " ".join(plain.split()[:50]), " ".join(short.split()[60:120]), "a b c " * 40])]
    rows.append((400, f"{plain} between {plain} and {short}"))  # one text twice in itself
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = all_repeated(docs).collect()
    spans = covered((r.doc_id, r.start, r.stop) for r in found)
    assert spans >= brute_windows(rows) and len(spans) == sum(r.n_words for r in found)
    assert all(r.first_doc_id <= r.doc_id for r in found)
    assert {203, 204, 205, 301, 303, 305, 306, 400} <= {r.doc_id for r in found} and not {200, 201, 300, 302, 304} & {r.doc_id for r in found}
    # nothing but near copies of shared passages besides
    assert {doc for doc, _ in spans - brute_windows(rows)} <= {k for k in range(0, 120, 3)} | {203, 400}
    # a text of its own length and one word more: the copies of a text are removed whole, its first stays
    assert {(r.doc_id, r.start, r.first_doc_id) for r in found if r.doc_id in (204, 205)} == {(204, 0, 0), (205, 0, 0)}


def test_shorter_passages_on_request(spark):
    rng = random.Random(13)
    plain = [f"p{rng.randrange(9000)}" for _ in range(40)]
    rows = [(k, " ".join([prose(rng, 3), *plain[:size], prose(rng, 3)])) for k, size in enumerate([40, 40, 30, 29])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = all_repeated(docs, plan=Passages(min_words=30)).collect()
    assert covered((r.doc_id, r.start, r.stop) for r in found) == brute_windows(rows, 30)
    assert all_repeated(docs).collect() == []


def test_near_copies_inside_running_text(spark):
    """Sentences of about 11 words run on before and after the passage; changed words are evenly spaced."""
    rng = random.Random(14)
    rows, planted = [], {}
    for k in range(100):
        size, changes = [(60, 1), (80, 1), (120, 2), (160, 3)][k % 4]
        words = [f"q{rng.randrange(9000)}" + ("." if rng.random() < 1 / 11 else "") for n in range(size)]
        near = list(words)
        for c in range(changes):
            near[(c + 1) * size // (changes + 1)] = "changed"
        before = prose(rng, 3).rstrip(".!?").split()
        rows.append((2 * k, " ".join([prose(rng, 2), *words, prose(rng, 2)])))
        rows.append((2 * k + 1, " ".join([*before, *near, "and", prose(rng, 3)])))
        planted[2 * k + 1] = set(range(len(before), len(before) + size))
    rows += [(1000 + k, prose(rng, 12)) for k in range(200)]
    found = all_repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    caught = {}
    for r in found:
        caught.setdefault(r.doc_id, set()).update(range(r.start, r.stop))
        assert r.first_doc_id == r.doc_id - 1
    assert set(caught) == set(planted)  # recall 1, and no clean text
    words = sum(len(caught[d] & planted[d]) for d in planted) / sum(map(len, planted.values()))
    assert words > 0.99 and all(len(caught[d] - planted[d]) == 0 for d in planted)


def test_inserted_and_lost_words(spark):
    rng = random.Random(15)
    words = [f"q{rng.randrange(9000)}" for _ in range(120)]
    rows = [(1, " ".join([prose(rng, 3), *words, prose(rng, 3)])),
            (2, " ".join([prose(rng, 3), *words[:60], "more", *words[60:], prose(rng, 3)])),
            (3, " ".join([prose(rng, 3), *words[:60], *words[62:], prose(rng, 3)]))]
    found = all_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.first_doc_id) for r in found) == [(2, 121, 1), (3, 118, 1)]


def test_components_name_the_first_passage(spark):
    """A chain of near copies: each is similar to the one before, the last not to the first."""
    rng = random.Random(16)
    words = [f"q{rng.randrange(9000)}" for _ in range(120)]
    rows = []
    for k in range(6):
        words = list(words)
        words[10 + 20 * k] = f"changed{k}"
        rows.append((k, " ".join([prose(rng, 2), *words, prose(rng, 2)])))
    found = all_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == {(k, 0) for k in range(1, 6)}


def test_passages_are_cut_out(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, start string")
    found = all_repeated(docs)
    kept = {r.doc_id: r.text for r in remove_passages(docs, found).collect()}
    before = dict(rows)
    gone = {}
    for r in found.collect():
        gone[r.doc_id] = gone.get(r.doc_id, 0) + r.n_words
    assert len(kept) == len(rows)
    for doc, text in kept.items():
        assert len((text or "").split()) == len((before[doc] or "").split()) - gone.get(doc, 0)
        if doc not in gone:
            assert text == before[doc]
    assert without(b"a b  c\nd", [(0, 1), (2, 3)]) == b" b\nd"


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    rng = random.Random(2)
    passage, other = prose(rng, 9), prose(rng, 15)
    docs = spark.createDataFrame([(None, passage), (1, passage), (1, passage), (1, other), (2, passage), (3, "x " + other)], schema)
    assert {(r.doc_id, r.first_doc_id) for r in all_repeated(docs).collect()} == {(2, 1), (3, 1)}
    assert all_repeated(spark.createDataFrame([], schema)).collect() == []
    named = spark.createDataFrame([("a", passage, 1), ("b", passage, 2), ("c", None, 3)], "doc_id string, text string, digest int")
    assert [(r.doc_id, r.start, r.first_doc_id) for r in all_repeated(named).collect()] == [("b", 0, "a")]


def test_many_hubs_are_not_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    before = sorted(all_repeated(docs).collect())
    monkeypatch.setattr(paragraphs, "HUBS", 0)
    assert before and sorted(all_repeated(docs).collect()) == before


def test_a_hub_of_many_texts_in_proportion(spark):
    """A phrase that all texts share is no passage, and leads to one comparison a text."""
    rng = random.Random(17)
    phrase = " ".join(f"h{k}" for k in range(30))
    rows = [(k, f"{prose(rng, 3)} {phrase} {prose(rng, 3)}") for k in range(3000)]
    assert all_repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect() == []


def test_passages_whose_keys_all_stand_in_earlier_texts_too(spark, monkeypatch):
    """Earlier texts hold the passage in pieces under 51 words, so no later text finds it by the first text of a key."""
    monkeypatch.setattr(paragraphs, "BLOCK", 2)  # several blocks to a key
    rng = random.Random(11)

    def fill(n):
        return [f"f{rng.randrange(10**9)}" for _ in range(n)]

    rows = []
    for k in range(5):
        passage = [f"p{k}x{rng.randrange(10**6)}" for _ in range(60)]
        near, longer = list(passage), passage[:30] + ["put", "in"] + passage[30:]
        near[30] = "changed"
        pieces = [passage[:36], passage[24:], near[:36], near[24:], near[:36], longer[:36], longer[24:]]
        later = [passage, near, longer, passage]
        for i, words in enumerate(pieces + later):
            rows.append((100 * k + i, " ".join(fill(40) + words + fill(40))))
    spans = all_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.first_doc_id): (r.start, r.stop) for r in spans}
    assert got == {(100 * k + i, 100 * k + 7): (40, 102 if i == 9 else 100) for k in range(5) for i in (8, 9, 10)}


def test_a_later_place_of_a_key_in_a_text_is_compared_too(spark):
    rng = random.Random(12)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(60)]
    fill = [f"f{rng.randrange(10**9)}" for _ in range(200)]
    first = fill[:40] + passage[:36] + fill[40:80] + passage[24:] + fill[80:90] + passage + fill[90:100]
    rows = [(1, " ".join(first)), (2, " ".join(fill[100:120] + passage + fill[120:140]))]
    spans = all_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start, r.stop, r.first_doc_id) for r in spans] == [(2, 20, 80, 1)]


def test_a_run_of_one_word_has_few_places():
    """Before, each of its places met each place of the other texts' runs."""
    texts = ["x " * 20 + "the " * 2000 + "y " * 20, "a b c " * 500, " ".join(f"w{k}" for k in range(60))]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], names=["id", "text"])
    listed = next(paragraphs._profiles(PLAN, [batch]))
    for text, twice, keys, places in zip(texts, *(listed.column(c).to_pylist() for c in ("twice", "keys", "places"))):
        place, key = keys_of(word_hashes(text.encode()))
        every = {}
        for p, k in zip(place.tolist(), key.view(np.int64).tolist()):
            every.setdefault(k, []).append(p)
        kept = {}
        for p, k in zip(places, keys):
            kept.setdefault(k, []).append(p)
        assert kept == {k: p if len(p) < 5 else p[:2] + p[-2:] for k, p in every.items()} and twice == (len(place) > len(every))
    far = np.array([1, 21, 41, 61, 81, 101, 103, 106, 110, 115])  # apart, or at no constant distance: each one counts
    assert paragraphs.outer_places(far, np.zeros(10, np.uint64)).all()


def test_a_block_may_reach_over_batches():
    rng = np.random.default_rng(19)
    passage = rng.integers(0, 1 << 31, 60, dtype=np.uint32)
    rows = []
    for key in range(3):
        for digest in range(4):
            words = np.r_[rng.integers(0, 1 << 31, 30, dtype=np.uint32), passage + np.uint32(key), rng.integers(0, 1 << 31, 30, dtype=np.uint32)]
            rows.append(dict(key=key, lo=0, hi=0, id=digest, digest=digest, place=50, part=0, cls=None, told=False, at=0, words=words.tobytes()))
    table = pa.Table.from_pylist(rows)
    links = [r for b in paragraphs._block_links(PLAN, table.to_batches(max_chunksize=3)) for r in b.to_pylist()]
    assert {(r["x"], r["start"], r["stop"]) for r in links} == {(k, 30, 90) for k in (1, 2, 3)} and len(links) == 3 * 3
    assert list(paragraphs._block_links(PLAN, [])) == []


def test_places_in_runs_of_one_word_need_little_memory():
    """Before, each run of 13 words of a place met each equal one of all places: 4 million pairs a place here."""
    rng = np.random.default_rng(21)
    rows = []
    for digest in range(400):
        words = [rng.integers(0, 1 << 31, 9, dtype=np.uint32)]
        for _ in range(4):
            words += [np.full(45, 7, np.uint32), rng.integers(0, 1 << 31, 3, dtype=np.uint32)]
        rows.append(dict(key=7, lo=0, hi=0, id=digest, digest=digest, place=57, part=0, cls=None, told=False, at=0, words=np.concatenate(words)[:57 + GRAM + paragraphs.CONTEXT].tobytes()))
    tracemalloc.start()
    links = paragraphs._block(rows, False, PLAN)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links == [] and peak < 40 << 20


def family(rng, texts: int, changes) -> list[dict]:
    """Places of one key in texts that are copies of one another; ``changes`` are made to the words around it."""
    base = rng.integers(0, 1 << 31, 300, dtype=np.uint32)
    rows = []
    for digest in range(texts):
        before, key, after = changes(base[:130].copy()), base[130:154], changes(base[154:].copy())
        words = np.concatenate([before, key, after])
        place = len(before)
        at = max(0, place - paragraphs.CONTEXT)
        rows.append(dict(key=7, lo=0, hi=0, id=digest, digest=digest, place=place, part=0, cls=None, told=False, at=at,
                         words=words[at: place + GRAM + paragraphs.CONTEXT].tobytes()))
    return rows


def test_spans_of_many_pairs_equal_those_of_each_pair():
    rng = np.random.default_rng(24)

    def changes(words):
        for at in rng.integers(0, len(words), 3):
            words[at] = rng.integers(0, 1 << 31)
        if rng.random() < 0.5:  # a word lost, a word put in, a run of one word
            at = rng.integers(0, len(words), 2)
            words = np.insert(np.delete(words, at[0]), min(at[1], len(words) - 1), 9)
        if rng.random() < 0.3:
            words[20:20 + rng.integers(20, 70)] = 9
        return words

    rows = family(rng, 40, changes)
    around = paragraphs._Around(rows, PLAN)
    i, j = np.tril_indices(len(rows), -1)
    assert around.bounded(1, len(rows), i[:780], j[:780]).any()
    got = {}
    for k, span in around.spans(i, j):
        got.setdefault((int(i[k]), int(j[k])), []).append(tuple(span))
    want = {}
    lists = [np.frombuffer(r["words"], np.uint32) for r in rows]
    runs = [{} for _ in rows]
    for held, words in zip(runs, lists):
        for at, h in enumerate(paragraphs.run_hashes(words.astype(np.uint64), GRAM).tolist()):
            held.setdefault(h, at)
    for a, b in zip(i.tolist(), j.tolist()):
        both = [(at, runs[b][h]) for h, at in runs[a].items() if h in runs[b]] + [tuple(rows[k]["place"] - rows[k]["at"] for k in (a, b))]
        p, q = np.array(both).T
        order, edges = paragraphs.chains(p, np.zeros(len(p), np.int64), q)
        found = [s for x, y in zip(edges, edges[1:]) for s in paragraphs.verified(lists[a], lists[b], 0, p[order[x:y]], q[order[x:y]], PLAN)]
        if found:
            want[a, b] = found
        if found and (a, b) not in got:  # only on the key's diagonal, where too few words go on from the key
            assert (p - q == p[-1] - q[-1]).all()
            del want[a, b]
    assert got == want and len(want) > 50


def test_pairs_of_a_block_are_compared_in_arrays():
    """Before, each pair took some hundred calls."""
    rng = np.random.default_rng(25)

    def changes(words):
        words[rng.integers(0, 16)::16] = rng.integers(0, 1 << 31)
        return words

    rows, calls = family(rng, 80, changes), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    links = paragraphs._block(rows, False, PLAN)
    sys.setprofile(None)
    assert calls < 80 * 79 // 2 * 3 and len(links) < 100


def test_shared_shingles_equal_brute_force():
    rng = np.random.default_rng(22)
    lists = [rng.integers(0, 3, rng.integers(GRAM, 140)).astype(np.uint32) for _ in range(20)]
    lists += [np.full(90, 1, np.uint32), np.tile(np.arange(31, dtype=np.uint32), 5), lists[0]]
    found = paragraphs._SharedShingles(lists, PLAN)
    sets = [shingles(x.tolist()) for x in lists]
    for i, x in enumerate(lists):
        assert found.common(i).tolist()[:i] == [len(sets[i] & s) for s in sets[:i]]
        if len(x) >= PLAN.min_words:
            assert found.fewest[i] == min(len(shingles(x[k: k + PLAN.min_words].tolist())) for k in range(len(x) - PLAN.min_words + 1))
        else:
            assert found.fewest[i] > sum(len(y) - 4 for y in lists)


def test_a_span_goes_on_as_its_score_tells():
    rng = random.Random(23)
    for _ in range(500):
        n = rng.randrange(65)
        wrong = sorted(rng.sample(range(100, 100 + n), rng.randrange(min(n, 6) + 1))) if n else []
        score = np.cumsum([-paragraphs.CHANGED if k in wrong else 1 for k in range(100, 100 + n)])
        best = int(np.argmax(score)) + 1 if n and score.max() > 0 else 0
        assert paragraphs._extent(wrong, 100, 1, n) == best
        assert paragraphs._extent([199 - k for k in reversed(wrong)], 100, -1, n) == best
