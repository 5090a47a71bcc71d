"""Near-duplicates, passages, language model, token counts, rules, mixing: brute force and stated bounds."""

import binascii
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.sources.storage import written
from orrery.llm import lm_score as LM, mixing as M, near_dedup as N, quality_rules as R, substring_dedup as P, token_counts as C

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def edited(text, rng, n):
    ws = text.split()
    for _ in range(n):
        ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**6)}"
    return " ".join(ws)


def shingle_set(text):
    ws = SPACED.findall(low(text))
    return frozenset(tuple(ws[i : i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)] if ws else [])


def test_near_duplicates(docs_of, odd, prose_of):
    rng = random.Random(3)
    rows = list(odd)
    base = prose_of(70, 200)
    rows += [(100 + i, edited(base, rng, rng.randrange(0, 9))) for i in range(60)]  # links in chains, not all to one
    rows += [(300 + i, prose_of(71, 150)) for i in range(40)] + [(400 + i, prose_of(72 + i, 150)) for i in range(10)]
    sets = [(d, shingle_set(t)) for d, t, *_ in rows]
    up = {d: d for d, _ in sets if d is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                up[q] = p
    got = N.near_duplicates(docs_of(rows)).collect()
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((d, len(s)) for d, s in sets)
    for r in got:
        want = None if r["doc_id"] is None else find(r["doc_id"])
        assert r["component_id"] == want and r["kept"] == (r["doc_id"] == want)
    assert N.near_duplicates(docs_of([])).count() == 0


def test_bucket_parts_see_all_pairs(monkeypatch, docs_of, prose_of):
    monkeypatch.setattr(N, "PART", 7)
    rng = random.Random(4)
    base = prose_of(80, 120)
    rows = [(i, edited(base, rng, 5)) for i in range(50)]
    sets = [shingle_set(t) for _, t in rows]
    links = {(i, j) for i in range(50) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    parts = list(range(50))
    for i, j in sorted(links) * 50:
        parts[i] = parts[j] = min(parts[i], parts[j])
    assert {r["doc_id"]: r["component_id"] for r in N.near_duplicates(docs_of(rows)).collect()} == dict(enumerate(parts))


def test_compact_windows_cover_each_subsequence_once():
    values = np.random.default_rng(1).integers(0, 1 << 60, 90, dtype=np.uint64)
    seen = Counter()
    for a, c, b in P.compact_windows(values, 7):
        for i in range(a, c + 1):
            for j in range(max(c, i + 6), b + 1):
                seen[i, j] += 1
                assert (values[i : j + 1] >> np.uint64(16)).min() == values[c] >> np.uint64(16)
    assert seen == Counter({(i, j): 1 for i in range(90) for j in range(i + 6, 90)})
    assert len(P.compact_windows(np.zeros(50_000, np.uint64), 46)) < 5_000  # equal values: flat, not one long chain


def test_repeated_passages(docs_of, odd, prose_of):
    shared, other = prose_of(90, 60), prose_of(91, 75)
    rows = list(odd)
    rows += [(100 + i, prose_of(200 + i, 150) + " " + shared + "\n" + prose_of(300 + i, 40 + i)) for i in range(30)]
    rows += [(200 + i, prose_of(400 + i, 30) + " " + edited(other, random.Random(i), 1) + " " + prose_of(500 + i, 300)) for i in range(5)]
    rows += [(300 + i, prose_of(600 + i, 200)) for i in range(20)]
    rows += [(400 + i, prose_of(700 + i, 90) + " " + " ".join(shared.split()[:30])) for i in range(5)]
    got = P.repeated_passages(docs_of(rows)).collect()
    classes = defaultdict(set)
    for r in got:
        classes[r["class_id"]].add(r["doc_id"])
        assert r["class_docs"] >= 2
    assert classes[100] == set(range(100, 130)) and classes[200] == set(range(200, 205)) and classes[5] == {5, 6}
    place = {r["doc_id"]: (r["first_word"], r["last_word"]) for r in got}
    assert all(place[100 + i] == (150, 209) for i in range(30))
    assert not {d for s in classes.values() for d in s if d is not None} & ({1, 2, 3, 4, 9} | set(range(300, 320)) | set(range(400, 405)))
    assert P.repeated_passages(docs_of([])).count() == 0


def test_passages_inside_near_copies(docs_of, prose_of):
    a = prose_of(95, 400).split()
    b = [w if 100 <= i < 170 or i % 4 else f"x{i}" for i, w in enumerate(a)]
    got = P.repeated_passages(docs_of([(1, " ".join(a)), (2, " ".join(b))])).collect()
    assert {(r["doc_id"], r["class_id"]) for r in got} == {(1, 1), (2, 1)}
    assert all(r["first_word"] <= 101 and r["last_word"] >= 168 for r in got)


def test_passages_with_inserted_and_replaced_runs():
    rng = random.Random(8)
    fresh = lambda n: [rng.randrange(1 << 60) for _ in range(n)]
    grams = lambda ws: np.array([hash(tuple(ws[i : i + 5])) & ((1 << 62) - 1) for i in range(len(ws) - 4)], np.uint64)
    tried = 0
    for size in (8, 12, 16, 20, 25):
        for n in range(56, 190, 12):
            for share in (0.3, 0.5, 0.7):
                for left_out in (0, size):
                    passage, at = fresh(n), int(n * share)
                    changed = passage[:at] + fresh(size) + passage[at + left_out :]
                    p, q = grams(passage), grams(changed)
                    both = len(set(p.tolist()) & set(q.tolist()))
                    if len(changed) < n or 100 * both < 75 * (len(p) + len(q) - both):
                        continue
                    tried += 1
                    found = P.common_passages(grams(fresh(40) + passage + fresh(40)), grams(fresh(60) + changed + fresh(60)), 46, 75)
                    assert [r[:4] for r in found] == [(40, 39 + len(p), 60, 59 + len(q))], (size, n, share, left_out)
    assert tried > 100


def test_passage_with_inserted_run_is_found(docs_of, prose_of):
    passage, more = prose_of(97, 90).split(), prose_of(98, 10).split()
    changed = " ".join(passage[:45] + more + passage[45:])
    rows = [(1, prose_of(800, 150) + " " + " ".join(passage) + " " + prose_of(801, 80)), (2, prose_of(802, 60) + " " + changed + " " + prose_of(803, 90))]
    got = {(r["doc_id"], r["first_word"], r["last_word"]) for r in P.repeated_passages(docs_of(rows)).collect()}
    assert got == {(1, 150, 239), (2, 60, 159)}


def test_passages_repeated_in_each_document(docs_of, prose_of):
    rows, want = [], set()
    for i in range(16):  # whichever document has the smaller hash
        passage = prose_of(5000 + i, 60)
        often = [x for j in range(4) for x in (prose_of(6000 + 10 * i + j, 300), passage)]
        rows += [(2 * i, " ".join(often)), (2 * i + 1, prose_of(7000 + i, 100) + " " + passage + " " + prose_of(8000 + i, 100))]
        want |= {(2 * i, 300 + 360 * j) for j in range(4)} | {(2 * i + 1, 100)}
    docs = docs_of(rows)
    uids = {r["doc_id"]: r["uid"] for r in docs.select("doc_id", F.xxhash64("text").alias("uid")).collect()}
    assert {uids[2 * i] < uids[2 * i + 1] for i in range(16)} == {True, False}
    got = P.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["first_word"]) for r in got} == want
    apart = P.repeated_passages(docs.repartition(32, "doc_id")).collect()
    assert {(r["doc_id"], r["first_word"]) for r in apart} == want


@pytest.mark.parametrize("held_too, place", [(40, "start"), (40, "middle"), (40, "end"), (45, "start")])
def test_texts_with_a_part_of_a_passage_take_no_link(docs_of, prose_of, held_too, place):
    rows, pairs = [], 60
    fill = lambda seed, n: prose_of(seed, n, 10**6)
    for i in range(pairs):
        passage = fill(20_000 + i, 60).split()
        at = {"start": 0, "middle": (60 - held_too) // 2, "end": 60 - held_too}[place]
        part = " ".join(passage[at : at + held_too])
        for j in range(12):
            seed = 40_000 + 100 * i + 2 * j
            rows.append((100 * i + j, " ".join([fill(seed, 100), " ".join(passage) if j in (3, 8) else part, fill(seed + 1, 100)])))
    got = defaultdict(set)
    for r in P.repeated_passages(docs_of(rows)).collect():
        got[r["class_id"]].add(r["doc_id"])
    assert set(map(frozenset, got.values())) == {frozenset({100 * i + 3, 100 * i + 8}) for i in range(pairs)}


def test_texts_of_repeated_lines_have_few_places(docs_of, prose_of):
    """Chains at all offsets between repeated lines are one place, and other passages of the two texts are still found."""
    assert P._merged([[0, 99, 0, 99], [0, 99, 10, 90], [200, 260, 0, 60], [5, 104, 0, 99]]) == [[0, 104, 0, 99], [200, 260, 0, 60]]
    line, passage = prose_of(50, 12) + "\n", " " + prose_of(51, 70) + "\n"
    rows = [(1, line * 120 + passage + prose_of(52, 100)), (2, prose_of(53, 90) + "\n" + line * 80 + prose_of(54, 200) + passage)]
    windows = list(P._windows(46)(iter([_batch(rows)])))
    key = lambda r: (r["key"], r["own"]["uid"], r["own"]["right"], r["own"]["left"])
    table = pa.Table.from_pylist(sorted((r for b in windows for r in b.to_pylist()), key=key), schema=windows[0].schema)
    links = sorted((r for b in P._stars(iter(table.to_batches())) for r in b.to_pylist()), key=lambda r: (r["a"], r["b"]))
    places = [r for b in P._join_intervals(iter(pa.Table.from_pylist(links).to_batches())) for r in b.to_pylist()]
    assert 1 <= len(places) <= 6
    got = [(r["doc_id"], r["first_word"], r["last_word"]) for r in P.repeated_passages(docs_of(rows)).collect()]
    assert any(d == 1 and a <= 1440 and b >= 1509 for d, a, b in got) and any(d == 2 and a <= 1250 and b >= 1319 for d, a, b in got)
    assert any(d == 1 and a <= 60 and b >= 840 for d, a, b in got) and any(d == 2 and a <= 150 and b >= 1040 for d, a, b in got)


def test_copied_texts_are_one_text(docs_of, prose_of):
    passage = prose_of(30, 60)
    own, shared, short = prose_of(31, 80), prose_of(32, 70) + " " + passage, prose_of(33, 49)
    rows = [(i, own) for i in range(5)] + [(10 + i, shared) for i in range(4)] + [(20, passage + " " + prose_of(34, 90)), (21, short), (22, short), (30, own)]
    got = {(r["doc_id"], r["first_word"], r["last_word"], r["class_id"], r["class_docs"]) for r in P.repeated_passages(docs_of(rows)).collect()}
    assert got == {(i, 0, 79, 0, 6) for i in (0, 1, 2, 3, 4, 30)} | {(10 + i, 0, 129, 10, 5) for i in range(4)} | {(20, 0, 59, 10, 5)}


def test_contexts_of_large_keys_in_blocks(monkeypatch, docs_of, prose_of):
    """Blocks smaller than a key: its texts stay connected."""
    passage = prose_of(35, 60)
    rows = [(i, prose_of(9000 + 2 * i, 60) + " " + passage + " " + prose_of(9001 + 2 * i, 60)) for i in range(40)]
    windows = [b for d in range(4) for b in P._windows(46)(iter([_batch(rows[d::4])]))]
    key = lambda t: (t["key"], t["own"]["uid"], t["own"]["right"], t["own"]["left"])
    table = pa.Table.from_pylist(sorted((r for b in windows for r in b.to_pylist()), key=key), schema=windows[0].schema)
    monkeypatch.setattr(P, "BLOCK", 16)
    links = [r for b in P._stars(iter(table.to_batches(max_chunksize=7))) for r in b.to_pylist()]
    parent = list(range(40))
    for r in links:
        assert r["a"] < r["b"]
        parent = [min(parent[r["a"]], parent[r["b"]]) if c in (parent[r["a"]], parent[r["b"]]) else c for c in parent]
    assert set(parent) == {0}


def test_all_windows_of_a_key_are_linked(prose_of):
    part = prose_of(36, 50)
    rows = [(i, " ".join([prose_of(9100 + 2 * i, 60), edited(part, random.Random(i), 1), prose_of(9101 + 2 * i, 60)])) for i in range(8)]
    windows = list(P._windows(46)(iter([_batch(rows)])))
    held = sorted((r for b in windows for r in b.to_pylist()), key=lambda r: (r["key"], r["own"]["uid"], r["own"]["right"], r["own"]["left"]))
    texts = defaultdict(set)
    for r in held:
        texts[r["key"]].add((r["own"]["uid"], r["own"]["left"]))
    want = {(x, y) for s in texts.values() for x in s for y in s if x[0] < y[0]}
    table = pa.Table.from_pylist(held, schema=windows[0].schema)
    got = {((r["a"], r["a_left"]), (r["b"], r["b_left"])) for b in P._stars(iter(table.to_batches())) for r in b.to_pylist()}
    assert len(want) > 28 and got == want


def test_near_passages_among_many_texts_with_their_middle(docs_of, prose_of):
    """Beside the centre a pair of near passages agrees for less than each with the texts that hold only the middle."""
    rows, pairs = [], 12
    fill = lambda seed, n: prose_of(seed, n, 10**6)
    for i in range(pairs):
        passage = fill(60_000 + i, 80).split()
        near = [f"x{i}" if j in (24, 60) else w for j, w in enumerate(passage)]
        for j in range(26):
            held = passage if j == 3 else near if j == 17 else passage[20:64]
            rows.append((100 * i + j, " ".join([fill(70_000 + 100 * i + 2 * j, 100), *held, fill(70_001 + 100 * i + 2 * j, 100)])))
    got = defaultdict(set)
    for r in P.repeated_passages(docs_of(rows)).collect():
        got[r["class_id"]].add(r["doc_id"])
    assert set(map(frozenset, got.values())) == {frozenset({100 * i + 3, 100 * i + 17}) for i in range(pairs)}


def test_windows_without_a_passage_at_their_centres_are_no_pair():
    """Texts that share many shingles, but nowhere around the centre enough of them, need no verification."""
    rng = np.random.default_rng(3)
    base = rng.integers(1, 1 << 32, 125, dtype=np.uint32)
    fresh = lambda: rng.integers(1, 1 << 32, 125, dtype=np.uint32)
    third = np.where(np.arange(125) % 3 == 2, base, fresh())  # the centre and 41 others, none of them neighbours
    near = np.where(np.isin(np.arange(125), range(40, 45)), fresh(), base)
    rows = [(1, base), (2, third), (3, near), (4, fresh())]
    batch = pa.RecordBatch.from_pylist(
        [{"key": 1, "i": 0, "j": 0, "uid": u, "class": None, "left": 0, "centre": 62, "right": 124, "need": 35, "part": 0, "shingles": x.tobytes()} for u, x in rows],
        pa.schema([(c, pa.int64()) for c in ("key", "i", "j", "uid", "class", "left", "centre", "right", "need", "part")] + [("shingles", pa.binary())]),
    )
    got = [(r["a"], r["b"], r["tree"]) for b in P._alike(46, 75)(iter([batch])) for r in b.to_pylist()]
    assert got == [(1, 3, True)]


def test_near_copies_of_one_text_are_compared_where_they_can_be_similar(monkeypatch, docs_of, prose_of):
    """Of 40 texts of which any two are similar in few places only a part of the pairs is verified."""
    base = prose_of(37, 300, 10**6).split()
    rows = [(i, " ".join(w if (j * 7 + i * 5) % 19 > 1 or 100 <= j < 104 else f"x{i}y{j}" for j, w in enumerate(base))) for i in range(40)]
    seen, verified = [], P._verified
    monkeypatch.setattr(P, "_verified", lambda places, *args: seen.append(places.count()) or verified(places, *args))
    P.passage_pairs(docs_of(rows))
    assert seen and sum(seen[1:]) < 40


def _of_key(rows, **more):
    """Windows `(uid, class, shingles)` of one key with the centre in the middle."""
    names = ("key", "i", "j", "uid", "class", "left", "centre", "right", "need", "part", *more)
    schema = pa.schema([(c, pa.int64()) for c in names] + [("shingles", pa.binary())])
    fixed = {"key": 1, "i": 0, "j": 0, "left": 0, "centre": 62, "right": 124, "need": 35, "part": 0, **more}
    return pa.RecordBatch.from_pylist([fixed | {"uid": u, "class": c, "shingles": x.tobytes()} for u, c, x in rows], schema)


def test_near_copies_of_a_key_give_pairs_that_connect_them():
    """Not all pairs: their number would grow with the square of the key's texts. Texts that are too different give none, whatever their number."""
    rng = np.random.default_rng(5)
    fresh = lambda n: rng.integers(1, 1 << 32, n, dtype=np.uint32)
    base, other = fresh(125), fresh(125)

    def near(x, *places):
        x = x.copy()
        for at in places:
            x[at : at + 5] = fresh(5)
        return x

    rows = [(i, 7 if i < 20 else None, near(base, rng.choice([3, 115]))) for i in range(60)]
    rows += [(100 + i, None, near(other, *range(2 + i % 3, 120, 11))) for i in range(40)]
    got = [r for b in P._alike(46, 75)(iter([_of_key(rows)])) for r in b.to_pylist()]
    assert len(got) == 40 and all(r["tree"] for r in got)  # one class and 40 texts
    parent = list(range(60))
    for r in got:
        a, b = (0 if x < 20 else x for x in (r["a"], r["b"]))
        parent = [parent[a] if c == parent[b] else c for c in parent]
    assert len({0 if i < 20 else parent[i] for i in range(60)} | {parent[0]}) == 1


def test_windows_unlike_all_others_of_a_large_key_go_first():
    rng = np.random.default_rng(6)
    fresh = lambda: rng.integers(1, 1 << 32, 125, dtype=np.uint32)
    base, centre = fresh(), np.arange(125) == 62
    line = np.isin(np.arange(125), range(45, 85))  # 40 shingles that many have: no passage
    found = {1: base, 2: np.where(np.isin(np.arange(125), range(90, 125)), fresh(), base)}
    rows = found | {10 + i: np.where(centre, base, fresh()) for i in range(20)} | {50 + i: np.where(line, base[::-1], fresh()) for i in range(20)}
    names = ["key", "uid", "class", "left", "centre", "right"]
    held = []
    for bucket in range(3):  # as dealt by values
        for uid, x in rows.items():
            at = np.flatnonzero(x % 3 == bucket).astype(np.uint16)
            held.append({"key": 1, "bucket": bucket, "uid": uid, "class": None, "left": 0, "centre": 62, "right": 124, "shingles": x[at].tobytes(), "spots": at.tobytes()})
    schema = [(c, pa.int64()) for c in [*names, "bucket"]]
    shared = P._shared(iter([pa.RecordBatch.from_pylist(held, pa.schema([*schema, ("shingles", pa.binary()), ("spots", pa.binary())]))]))
    spots = defaultdict(list)
    for b in shared:
        for r in b.to_pylist():
            spots[r["uid"]].append(r["spots"])
    lists = [{"key": 1, "uid": u, "class": None, "left": 0, "centre": 62, "right": 124, "spots": x} for u, x in spots.items()]
    batch = pa.RecordBatch.from_pylist(lists, pa.schema([*schema[:-1], ("spots", pa.list_(pa.binary()))]))
    assert [r["uid"] for b in P._able(46, 75)(iter([batch])) for r in b.to_pylist()] == [1, 2]


def test_passages_of_large_keys_in_parts(monkeypatch, docs_of, prose_of):
    """Keys larger than a part: all their near passages are found, in one class of many and among texts with a line of it."""
    monkeypatch.setattr(P, "PART", 6)
    monkeypatch.setattr(P, "BUCKET", 10)
    fill = lambda seed, n: prose_of(seed, n, 10**6)
    rows, want = [], set()
    for i in range(4):
        passage = fill(90_000 + i, 80).split()
        near = [f"x{i}" if j in (24, 60) else w for j, w in enumerate(passage)]
        full = {3, 17} if i % 2 else set(range(3, 18))
        want.add(frozenset(100 * i + j for j in full))
        for j in range(30):
            held = passage[20:64] if j not in full else near if j == 17 else passage
            rows.append((100 * i + j, " ".join([fill(91_000 + 100 * i + 2 * j, 100), *held, fill(91_001 + 100 * i + 2 * j, 100)])))
    got = defaultdict(set)
    for r in P.repeated_passages(docs_of(rows)).collect():
        got[r["class_id"]].add(r["doc_id"])
    assert set(map(frozenset, got.values())) == want


def test_passages_of_single_shingles_are_those_of_any():
    rng = random.Random(9)
    some = 0
    for _ in range(300):
        words = [rng.randrange(1 << 60) for _ in range(rng.randrange(50, 400))]
        other = list(words)
        for _ in range(rng.randrange(0, 14)):
            at, n = rng.randrange(len(other)), rng.choice([1, 1, 1, 2, 8, 20])
            other[at : at + rng.choice([0, n])] = [rng.randrange(1 << 60) for _ in range(n)]
        if rng.random() < 0.3:
            cut = rng.randrange(len(other))
            other = other[cut:] + other[:cut]
        x, y = (np.array([hash(tuple(t[i : i + 5])) & ((1 << 62) - 1) for i in range(len(t) - 4)], np.uint64) for t in (words, other))
        order = np.argsort(y)
        want = P._one_way(x, y, 46, 75)
        assert P._once_passages(x, y[order], order, 46, 75) == want == P.common_passages(x, y, 46, 75)
        some += len(want)
    assert some > 200


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["uid", "text"])


def held(doc_id):
    return doc_id is not None and binascii.crc32(str(doc_id).encode()) % 7 == 2


def test_language_model_base_and_norm(docs_of, odd, prose_of):
    rows = odd + [(1000 + i, prose_of(i, 120)) for i in range(40)]
    train = Counter()
    for d, t, *_ in rows:
        if not held(d):
            train.update(SPACED.findall(low(t)) + ["\0end"])
    n, v = sum(train.values()), len(train)
    for top in (LM.TOP, 50):  # 50: most counts come by the join
        got = defaultdict(list)
        for r in LM.lm_scores(docs_of(rows), top=top).collect():
            got[r["doc_id"]].append(r)
        for d, t, *_ in rows:
            tokens = SPACED.findall(low(t)) + ["\0end"]
            for r in got[d]:
                assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held(d), len(tokens), n)
                assert r["n_known"] == sum(train[x] > 0 for x in tokens)
                assert math.isclose(r["base_score"], sum(math.log10((train[x] + 1) / (n + v + 1)) for x in tokens), rel_tol=1e-9)
                assert r["score"] < 0
    empty = LM.lm_scores(docs_of([])).count()
    assert empty == 0


def test_model_is_normalised_and_learns(docs_of):
    rng = random.Random(9)
    words = {"de": [f"d{i}" for i in range(60)], "en": [f"e{i}" for i in range(60)]}

    def text(lang):
        out = [rng.choice(words[lang])]
        for _ in range(150):
            i = words[lang].index(out[-1])
            out.append(words[lang][(i + rng.choice([1, 2, 3])) % 60])
        return " ".join(out)

    rows = [(i, text("de" if i % 2 else "en")) for i in range(400)]
    got = LM.lm_scores(docs_of(rows).coalesce(2), rounds=5).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert got[0] / got[2] > got[1] / got[2] + 0.3  # log10 per held-out token
    m = LM.fresh_model(np.full(LM.CLASSES, 1 / LM.CLASSES))
    t = LM.multiplied(m._replace(q=np.random.default_rng(0).normal(0, 1, m.q.shape).astype(np.float32)))
    for a, b in ((0, 1), (LM.CLASSES, LM.CLASSES), (7, 900)):
        assert abs(np.exp(t.far[a] + t.near[b] - t.norm[a, b]).sum() - 1) < 1e-3


def test_token_counts(docs_of, odd):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    own = tiktoken.Encoding("t", pat_str=C.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = [len(own.encode_ordinary(t or "")) for _, t, *_ in odd]
    table = C.context_table(C.length_histogram(docs_of(odd), VOCABULARY))
    rows = table.orderBy("length").collect()
    assert [(r["length"], r["n_docs"]) for r in rows] == sorted(Counter(sizes).items())
    for r in rows:
        limit = r["length"]
        assert r["docs_over"] == sum(s > limit for s in sizes) and r["rank"] == sum(s <= limit for s in sizes)
        assert r["tokens_over"] == sum(s for s in sizes if s > limit)
        assert r["truncated_tokens"] == sum(min(s, limit) for s in sizes) and r["dropped_tokens"] == sum(max(0, s - limit) for s in sizes)
    got = {r["limit"]: (r["docs_over"], r["truncated_tokens"]) for r in C.truncated_totals(table, [0, 1, 3, 500, 10**7]).collect()}
    assert got == {k: (sum(s > k for s in sizes), sum(min(s, k) for s in sizes)) for k in (0, 1, 3, 500, 10**7)}
    q = {r["share"]: r["length"] for r in C.length_quantiles(table, [0.0, 0.5, 1.0]).collect()}
    assert q[1.0] == max(sizes) and q[0.5] == sorted(sizes)[math.ceil(len(sizes) / 2) - 1]
    assert C.context_table(C.length_histogram(docs_of([]), VOCABULARY)).count() == 0


def counted(text):
    text = text or ""
    ws = SPACED.findall(text)
    grams = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {i + o for i in range(len(ws) - 2) if grams[tuple(ws[i : i + 3])] > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, docs_of, odd, prose_of):
    rows = odd + [(20, "a b c a b c a b c d"), (21, "x\n\nx\ny\n x\n"), (22, "## * $%&|<> ok"), (23, (prose_of(1, 30) + "\n") * 3)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = defaultdict(list)
    for r in R.quality_verdicts(docs_of(rows), labels).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for d, t, *_ in rows:
        want = counted(t)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        for r in got[d]:
            assert tuple(r[c] for c in R.MEASURES[:5]) == want and r["base_failed"] == failed and r["kept"] == (not failed)
    assert R.quality_verdicts(docs_of([]), labels).count() == 0


@pytest.mark.parametrize("n, k, p", [(10, 0, 0.1), (500, 3, 0.02), (5000, 40, 0.01), (200_000, 1900, 0.01), (50, 49, 0.1), (1, 0, 0.01)])
def test_binomial_tail(spark, n, k, p):
    got = spark.range(1).select(R.tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    assert got == 1.0 if k > n * p else math.isclose(got, math.fsum(map(math.exp, logs)), rel_tol=1e-6)


def test_cutoffs_are_certified_per_stratum(spark, docs_of, prose_of):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(2600):
        lang = "en" if i % 2 else None
        bad = rng.random() < 0.2
        # without a language, good documents are full of marks too
        text = prose_of(i, 60) if lang and not bad else prose_of(i, 60).replace(" ", " ## ")
        rows.append((i, text, "s", lang))
        labels.append((i, int(not bad), 0))
    labels += [(3, None, 0), (None, 1, 0), (1, 0, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    measured = R.measures(docs_of(rows).select("doc_id", "text", F.coalesce("lang", F.lit("-")).alias("stratum")), "doc_id", "stratum")
    tests = R.certified(written(measured, "m"), table).collect()
    chosen = {(r["stratum"], r["rule"]): r for r in tests if r["chosen"]}
    assert chosen["en", "symbols"]["cutoff"] == 0.02 and chosen["-", "symbols"]["cutoff"] == 0.4
    assert all(r["n_rejected"] <= R.ALPHA / len(R.RULES) * r["n_good"] for r in chosen.values())
    kept = {r["doc_id"]: r["kept"] for r in R.quality_verdicts(docs_of(rows), table).collect()}
    assert all(kept[i] == (q == 1) for i, q, _ in labels[:2600] if i % 2 and i != 1) and all(kept[i] for i in range(0, 2600, 2))


def test_mix_meets_targets(docs_of, odd):
    rng = random.Random(6)
    rows = odd + [(1000 + i, "w " * rng.randrange(1, 60), rng.choice(["big"] * 12 + ["a", "b", "c", "é", None])) for i in range(3000)]
    docs = docs_of(rows)
    got = M.mix(docs).collect()
    assert len(got) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    by = {}
    for d, t, *rest in rows:
        by[d] = rest[0] if rest else "s0"
    for r in got:
        assert r["taken"] == r["repeats"] * r["size"] <= 3 * r["size"]
        s = by[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    want, free, left = {}, set(order), sum(size.values())
    while True:  # water-filling step by step
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * size[s]}
        if not over:
            want |= {s: share * weight[s] for s in free}
            break
        want |= {s: 3 * size[s] for s in over}
        left -= sum(3 * size[s] for s in over)
        free -= over
    longest = Counter()
    for r in got:
        longest[by[r["doc_id"]]] = max(longest[by[r["doc_id"]]], r["size"])
    for s in order:
        assert math.isclose(target[s], want[s], rel_tol=1e-9) and abs(taken[s] - want[s]) <= longest[s] / 2 + 1
    again = M.mix(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert M.mix(docs_of([])).count() == 0


def test_mix_moves_no_text(docs_of):
    plan = M.mix(docs_of([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowPython" not in plan and "MapInArrow" not in plan and "BatchEvalPython" not in plan
