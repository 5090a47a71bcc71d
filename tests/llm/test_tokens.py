"""Spelling variants, aligned tokens and token files against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from orrery.llm import align as A, segments as S, spelling as V, token_files as F

P = pytest.importorskip("public_tokenizers")
BYTE, PIECE = str(P.path("byte_bpe_50k.json")), str(P.path("piece_bpe_32k.model"))
HARD = [
    "  a\tb \n\n c", "a▁b c", "<|endoftext|> <s> x<|endoftext|>y", "漢字 かな 🙂 é́ ok", "\x00 a \x85 b　c   d", " " * 3000 + "z", "ﬁ ½ Ａ", "don't, × ÷, é. É;x",
    "a.\nB c\r\n\td", "it's 'quoted' 12,5 %%% ###", "x ", " ", "\n",
]


def hard_docs(docs_of, odd):
    return docs_of([*odd, *((100 + i, t) for i, t in enumerate(HARD))])


# ---- spelling


def variants(rows, spoil):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    n = {w: c for w, c in total.items() if len(w) >= 5 and c >= 3}
    near = {a: [b for b in n if a != b and one_apart(a, b)] for a in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("spoil", [0, 3])
def test_variants_equal_all_pairs(docs_of, odd, spoil):
    rng = random.Random(5)
    letters = "abbß"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.choice([4, 5, 6]))) + rng.choice(["", ",", "X"]) for _ in range(400)) for _ in range(12)]
    rows = [*((r[0], r[1]) for r in odd), *((50 + i, t) for i, t in enumerate(texts)), (90, "aabbaa " * 3 + "aabba " * 7 + "y" * 40_000 + (" " + "q" * 3000) * 3 + (" " + "q" * 3001) * 9)]
    out = V.spelling_variants(docs_of(rows), spoil)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == variants(rows, spoil)
    assert any(r[1] is not None and r[2] != r[1] for r in got)


def test_no_words(docs_of):
    assert V.spelling_variants(docs_of([])).count() == 0
    assert V.spelling_variants(docs_of([(1, None), (2, "abc abc abc")])).count() == 0


def test_trie_nodes_are_numbered_once_each(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(2000)})
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(7)
    for reverse in (False, True):
        number = {"": 0}
        for r in V.numbered_trie(table, reverse).collect():
            key = r["word"][::-1] if reverse else r["word"]
            assert len(r["path"]) == len(key)
            assert words[r["id"]] == r["word"] or reverse
            for i, node in enumerate(r["path"], 1):
                assert number.setdefault(key[:i], node) == node
        assert sorted(number.values()) == list(range(len(number)))


# ---- segments and files


def test_segments_encode_as_whole_texts(docs_of, odd):
    texts = [r.text or "" for r in hard_docs(docs_of, odd).select("text").collect()]
    rng = random.Random(4)
    alphabet = [" ", " ", "\n", "a", "B", "é", "×", "9", "'", "s", ".", ",", "漢", " ", "́", "<|endoftext|>", "_", "\t", "\x1f", " "]
    texts += ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(300)]
    for plain in (False, True):
        encode = S.Encoder(open(BYTE, "rb").read(), specials_as_text=plain, most=50)
        assert encode.cuts
        made, _ = S.tokenizer(open(BYTE, "rb").read(), plain)
        for low in range(0, len(texts), 40):
            part = texts[low : low + 40]
            ids, counts = encode(pa.array(part, pa.string()))
            want = [made.encode(t, add_special_tokens=False).ids for t in part]
            assert counts.tolist() == [len(x) for x in want]
            assert ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_planes_round_trip(unit):
    rng = np.random.default_rng(1)
    for top in (1, 2, 255, 256, 50_257, 1 << 20, (1 << 32) - 1):
        for n in (0, 1, 7, 8, 1000):
            ids = rng.integers(0, top, n, dtype=np.uint32)
            assert F.from_planes(F.to_planes(ids, unit), n, unit).tolist() == ids.tolist()
    assert F.to_planes(np.zeros(9, np.uint32), unit) == []


def token_digests(rows):
    made, _ = S.tokenizer(open(BYTE, "rb").read(), False)
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = made.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("unit,block,docs,ids", [("byte", 65536, 1 << 20, 1 << 28), ("bit", 100, 3, 1 << 28), ("byte", 64, 1 << 20, 5000)])
def test_files_equal_library(docs_of, odd, unit, block, docs, ids):
    table = hard_docs(docs_of, odd)
    out = F.token_round_trip(table, BYTE, unit=unit, block=str(block), filedocs=str(docs), fileids=str(ids))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = sorted((tuple(r) for r in out.collect()), key=lambda r: r[1])
    assert got == token_digests([(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()])


def test_files_read_in_small_tasks_and_without_ids(spark, docs_of, odd, tmp_path):
    table, folder = docs_of(odd), str(tmp_path / "tokens")
    F.write_tokens(table, BYTE, folder, end=7)
    back = spark.read.format("tokenplanes").option("taskIds", "500").load(folder)
    assert back.rdd.getNumPartitions() > 10
    rows = back.collect()
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 7 and len(r.ids) == 4 * r.n_tokens for r in rows)
    ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    light = spark.read.format("tokenplanes").schema("doc_id long, n_tokens long").load(folder)
    assert sorted((r.n_tokens for r in light.collect())) == sorted(r.n_tokens for r in rows)


def test_no_documents_make_no_files(docs_of):
    assert F.token_round_trip(docs_of([]), BYTE).count() == 0


# ---- aligned tokens


def aligned(rows):
    import sentencepiece

    made, _ = S.tokenizer(open(BYTE, "rb").read(), True)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    back, names = A.byte_level(), {i: t for t, i in made.get_vocab().items()}
    piece = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    held, times = [], Counter()
    for doc, text in rows:
        a = made.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ab, bb = [bytes(back[c] for c in names[i]) for i in a], [piece(i) for i in b]
        if not b"".join(ab) == b"".join(bb) == (" " + (text or "")).encode():
            a, b, ab, bb = [], [], [], []
        ends = [np.cumsum([len(x) for x in y]).astype(int).tolist() for y in (ab, bb)]
        groups, at = [], [0, 0]
        for border in sorted(set(ends[0]) & set(ends[1])):
            sides = []
            for k, ids in enumerate((a, b)):
                upto = ends[k].index(border, at[k]) + 1
                sides.append(",".join(map(str, ids[at[k] : upto])))
                at[k] = upto
            groups.append("|".join(sides))
        links = []
        i = j = 0
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
        times.update(set(links))
        held.append((doc, a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in times.items():
        best[x] = max(best[x], n)
    return sorted(
        (
            (doc, len(a), len(b), len(g), len(k), sum(times[p] == best[p[0]] for p in k), sum(times[p] for p in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
            for doc, a, b, g, k in held
        ),
        key=str,
    )


@pytest.mark.parametrize("chunk", [A.CHUNK, 1])
def test_alignment_equals_a_walk_over_whole_texts(docs_of, odd, monkeypatch, chunk):
    monkeypatch.setattr(A, "CHUNK", chunk)
    table = hard_docs(docs_of, odd)
    out = A.aligned_tokens(table, BYTE, PIECE)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == aligned([(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()])


def test_alignment_forgets_segments_and_keeps_results():
    texts = [" " + t for t in ("one two three", "a▁b c", "four five six seven", "one six") if t]
    files = open(BYTE, "rb").read(), open(PIECE, "rb").read()
    small, large = A.Aligner(*files, most=2), A.Aligner(*files)
    assert large.cuts
    for t in texts * 2:
        sums = []
        for own in (small, large):
            numbers, counts = own(pa.array([t], pa.string()))
            sums.append((own.table()[numbers].sum(0)[:3].tolist(), b"".join(own.strings[i] for i in numbers)))
        assert sums[0] == sums[1]


def test_jumping_labels_components():
    a, b = A.jump(np.array([2, 4, 5, 9]), np.array([1, 3, 4, 5, 6, 9]))
    assert a.tolist() == [0, 0, 1, 2] and b.tolist() == [0, 0, 0, 1, 2, 2]
    assert [x.tolist() for x in A.jump(np.zeros(0, int), np.zeros(0, int))] == [[], []]


def test_no_documents_align_to_nothing(docs_of):
    assert A.aligned_tokens(docs_of([]), BYTE, PIECE).count() == 0


def test_lengths_of_long_runs_equal_another_library():
    from orrery.llm import token_counts as C

    own = C.Counter(open(P.path("byte_bpe_50k.tiktoken"), "rb").read(), C.PATTERN)
    made, _ = S.tokenizer(open(BYTE, "rb").read(), True)
    texts = [*HARD, None]
    for run in (" " * 999, " " * 1000, "\n" * 1001, " \n" * 3000, "　\xa0" * 700, "\x1c" * 1500, "\t" * 5000):
        texts += [run, "a" + run, run + "b", f"a {run} b{run}{run}c", f"x{run}\x1c{run}'s", f"é{run}!"]
    texts.append(" " * 3_000_000 + "z" * 1_000_000 + "\n" * 1_000_000)
    got = own(pa.array(texts, pa.string())).tolist()
    assert got == [len(made.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_token_files_learn_a_segment_once(monkeypatch):
    """More distinct segments than 2**18, in three chunks that come twice."""
    encode = F._encoder(open(BYTE, "rb").read(), "learn once", False)
    learned = []
    monkeypatch.setattr(encode.memo, "learn", lambda new: (learned.append(len(new)), encode._learn(new)))
    chunks = [pa.array([" ".join(f"q{i}" for i in range(low, low + 100_000))]) for low in (10**6, 2 * 10**6, 3 * 10**6)]
    first = [encode(c)[0] for c in chunks]
    assert all(np.array_equal(a, encode(c)[0]) for a, c in zip(first, chunks)) and learned == [100_000] * 3
