"""Texts cut where no tokenizer merges across, so that each distinct segment is encoded once per worker.

A byte-level tokenizer splits a text by a pattern in which a space can only begin a piece or stand inside a run of white space.
So white space after a character that is none always begins a piece, and so does a mark after a letter or digit. Cuts are made
before spaces that follow U+0021..U+007E or U+00C0..U+07FF, where no version of Unicode has white space. Where the pattern alone decides, they
are also made before other ASCII white space there, and before ASCII marks but the apostrophe after ASCII letters and digits and U+00C0..U+00FF but
the two signs among them. Text without such places stays in one segment.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from orrery.llm import words as T

FILE_LIMIT = 64 << 20  # bytes of a vocabulary file that is sent to the tasks
MOST = 1 << 18  # distinct segments remembered by a worker
MOST_BYTES = 64 << 20  # and their bytes, unless one chunk of texts has more
BATCH = 1 << 13  # segments encoded at once


def read_file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file, read by Spark so that it may lie in any store."""
    row = spark.read.format("binaryFile").load(path).select("length", "content").first()
    if row["length"] > FILE_LIMIT:
        raise ValueError(f"{path} is larger than {FILE_LIMIT} bytes; it is no vocabulary")
    return bytes(row["content"])


def cut(texts: pa.Array, marks: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The segments of all texts as a binary array, and how many each text has; a null or empty text has none.

    `marks`: cut at all the places above, otherwise before spaces only."""
    data, at = T.text_bytes(texts)
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(len(at) - 1, np.int64)
    last, now = data[:-1], data[1:]
    two = np.zeros(len(last), bool)  # a character of two bytes ends here
    two[1:] = (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    solid = two | ((last > 0x20) & (last < 0x7F))
    if marks:
        latin = np.zeros(len(last), bool)
        latin[1:] = (data[:-2] == 0xC3) & (last[1:] != 0x97) & (last[1:] != 0xB7)
        here = solid & _WHITE[now] | (latin | _ALNUM[last]) & _MARK[now]
    else:
        here = solid & (now == 0x20)
    begins = np.zeros(len(data), bool)
    begins[1:] = here
    begins[at[:-1][at[:-1] < at[1:]]] = True
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(data)).astype(np.int64)
    whole = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return whole, np.diff(np.searchsorted(starts, at))


def _table(codes: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


_WHITE = _table([0x20, *range(0x09, 0x0E)])
_ALNUM = _table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])
_MARK = _table(set(range(0x21, 0x7F)) - set(np.flatnonzero(_ALNUM).tolist()) - {0x27})


class Ragged:
    """Rows of numbers of different lengths, in arrays that grow."""

    def __init__(self, kind: type) -> None:
        self.flat, self.first, self.rows = np.zeros(1 << 12, kind), np.zeros(1 << 10, np.int64), 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        ends = self.first[self.rows] + np.cumsum(counts)
        self.first = _room(self.first, self.rows + 1 + len(counts))
        self.first[self.rows + 1 : self.rows + 1 + len(counts)] = ends
        low = int(self.first[self.rows])
        self.flat = _room(self.flat, low + len(values))
        self.flat[low : low + len(values)] = values
        self.rows += len(counts)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of these rows one after another, and how many each has."""
        low = self.first[rows]
        return spread(self.flat, low, self.first[rows + 1] - low)


def spread(flat: np.ndarray, low: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of `flat` that start at `low`, one after another, and `counts`, their lengths."""
    at = np.repeat(low - np.cumsum(counts) + counts, counts)
    at += np.arange(len(at))
    return flat[at], counts


def _room(x: np.ndarray, n: int) -> np.ndarray:
    if n <= len(x):
        return x
    out = np.zeros(max(n, 2 * len(x)), x.dtype)
    out[: len(x)] = x
    return out


class Memo:
    """Numbers segments as they come and has the new ones learned in one batch. All are forgotten when there are too many."""

    def __init__(self, learn: Callable[[Sequence[bytes]], None], reset: Callable[[], None], most: int = MOST) -> None:
        self.learn, self.reset, self.most = learn, reset, most
        self.number: dict[bytes, int] = {}
        self.held = 0

    def numbers(self, segments: pa.Array, keep: bool = False) -> np.ndarray:
        """The number of each segment. `keep`: numbers given before stay good."""
        coded = segments.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if not keep and (len(self.number) > self.most or self.held > MOST_BYTES):
            self.number, self.held = {}, 0
            self.reset()
        new = [x for x in distinct if x not in self.number]
        if new:
            self.learn(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.held += sum(map(len, new))
        return np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]


def tokenizer(file: bytes, specials_as_text: bool):
    """The byte-level tokenizer of a JSON file, and whether its texts may be cut into segments."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core already
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(file.decode())
    made.encode_special_tokens = specials_as_text
    form = json.loads(file)
    split = form.get("pre_tokenizer") or {}
    cuts = (
        form.get("normalizer") is None and form.get("post_processor") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space") and not any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") for t in form.get("added_tokens", []))
    )
    return made, bool(cuts)


def encode_each(made, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts by the library, one after another, and how many each has."""
    ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for low in range(0, len(texts), BATCH):
        found = [e.ids for e in made.encode_batch_fast(texts[low : low + BATCH], add_special_tokens=False)]
        counts.append(np.fromiter(map(len, found), np.int64, len(found)))
        ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
    return np.concatenate(ids), np.concatenate(counts)


class Encoder:
    """Ids of whole texts by a byte-level tokenizer."""

    def __init__(self, file: bytes, specials_as_text: bool = False, most: int = MOST) -> None:
        self.made, self.cuts = tokenizer(file, specials_as_text)
        self.specials = [] if specials_as_text else [t.content.encode() for t in self.made.get_added_tokens_decoder().values()]
        self.known = Ragged(np.uint32)
        self.memo = Memo(self._learn, self._reset, most)

    def _reset(self) -> None:
        self.known = Ragged(np.uint32)

    def _learn(self, new: Sequence[bytes]) -> None:
        self.known.add(*encode_each(self.made, [x.decode() for x in new]))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has; a null or empty text has none."""
        if not self.cuts:
            return encode_each(self.made, texts.fill_null("").to_pylist())
        whole = T.text_bytes(texts)[0].tobytes()
        segments, counts = cut(texts, marks=not any(x in whole for x in self.specials))  # a cut at a mark may split one
        numbers = self.memo.numbers(segments)  # may replace what is known
        ids, sizes = self.known.take(numbers)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(upto[np.concatenate([[0], np.cumsum(counts)])])
