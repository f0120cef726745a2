"""Byte-level BPE by forced-boundary splitting.

A merge can only ever build a vocabulary token, so two neighbouring bytes that
stand side by side inside no token can never end up in one token: between them
lies a certain cut. The pre-tokenizer's boundaries are certain cuts too. Many
texts are cut at both in one vectorised pass, the different fragments are encoded
independently of each other (a worker keeps the ids of those it has met), and
their ids are concatenated. The vocabulary file is the ``tokenizers`` library's
JSON.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.store import small_batches
from ledgerline.llm.tokens import code_points, groups, hashed_spans, stretches

SPACE, LETTER, NUMBER, OTHER, END = 0, 1, 2, 3, 4
#: Stands after each of the texts that are cut together.
END_OF_TEXT = 0x110000
#: Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Fragments whose ids a worker keeps, twice: those met last, and those before.
KEPT_FRAGMENTS = 150_000


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, as character to byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + n)] = b
    return out


@lru_cache(1)
def character_classes() -> np.ndarray:
    """SPACE, LETTER, NUMBER or OTHER for each code point, END beyond them."""
    classes = np.full(0x110001, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            classes[cp] = LETTER
        elif kind == "N":
            classes[cp] = NUMBER
    classes[WHITE_SPACE] = SPACE
    classes[END_OF_TEXT] = END
    return classes


def pretoken_starts(cps: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in the code points of texts, each followed by END_OF_TEXT, and where those ends are: contractions, runs of letters, numbers or others with one blank before them, white space."""
    classes = character_classes()[cps]
    n = len(cps)
    start = np.ones(n, bool)
    if n < 2:
        return start
    space, end = classes == SPACE, classes == END
    blank = cps == 0x20
    same = classes[1:] == classes[:-1]
    start[1:] = ~same & ~(blank[:-1] & ~space[1:])
    # The last of several white spaces before a visible character is on its own, or begins that character's run.
    start[1:-1] |= space[1:-1] & space[:-2] & ~space[2:] & ~end[2:]
    quotes = np.flatnonzero(cps == 0x27)
    if len(quotes):
        before = quotes - 1
        opens = (quotes == 0) | ((classes[before] != OTHER) & ~blank[before])
        padded = np.concatenate([cps, np.zeros(2, cps.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for quote, size in ((quotes[opens & single], 2), (quotes[opens & double], 3)):
            start[quote + 1] = False
            after = quote + size
            start[after[after < n]] = True
    start |= end
    start[1:] |= end[:-1]
    return start


def _utf8_ends() -> tuple[np.ndarray, np.ndarray]:
    """The first and the last byte of each code point in UTF-8."""
    cp = np.arange(0x110000)
    first = np.select([cp < 0x80, cp < 0x800, cp < 0x10000], [cp, 0xC0 | cp >> 6, 0xE0 | cp >> 12], 0xF0 | cp >> 18)
    last = np.where(cp < 0x80, cp, 0x80 | cp & 0x3F)
    return np.append(first, 0).astype(np.uint8), np.append(last, 0).astype(np.uint8)


def _reject_others(path: str, spec: dict) -> None:
    """Raises ValueError for a file that asks for more than byte-level pre-tokens and merges."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    sound = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    plain = not any(model.get(k) for k in ("ignore_merges", "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    if not sound or not plain or model.get("type", "BPE") != "BPE" or any(x.get(k) for x in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError(f"{path} asks for what this encoder doesn't do")


class ForcedBoundaryBpe:
    """Encodes and decodes as ``tokenizers`` does with the same file and no added special tokens; special tokens' strings within a text are recognised."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _reject_others(path, spec)
        bytes_of = byte_characters()
        as_bytes = lambda token: bytes(bytes_of[c] for c in token)
        self.ids = {as_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {i: b for b, i in self.ids.items()} | {i: text.encode() for text, i in self.special.items()}
        #: A merge's rank by its two ids, and what it makes.
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.ranks.setdefault((self.ids[left], self.ids[right]), rank)
            self.made.append(self.ids[left + right])
        self._byte = [self.ids[bytes([b])] for b in range(256)]
        #: joined[a, b]: some token holds byte a right before byte b.
        self.joined = np.zeros((256, 256), bool)
        for token in self.ids:
            raw = np.frombuffer(token, np.uint8)
            self.joined[raw[:-1], raw[1:]] = True
        self._first, self._last = _utf8_ends()
        by_id = [self.token.get(i, b"") for i in range(max(self.token) + 1)]
        self._token_sizes = np.array([len(b) for b in by_id], np.int64)
        self._token_begins = np.cumsum(self._token_sizes) - self._token_sizes
        self._token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self._known: dict[bytes, tuple[int, ...]] = {}
        self._older: dict[bytes, tuple[int, ...]] = {}

    def cuts(self, cps: np.ndarray) -> np.ndarray:
        """Where fragments start: at pre-tokens, and between characters whose meeting bytes no token joins."""
        start = pretoken_starts(cps)
        start[1:] |= ~self.joined[self._last[cps[:-1]], self._first[cps[1:]]]
        return start

    def _merged(self, raw: bytes) -> list[int]:
        """The ids of one fragment, by merging the pair of least rank, leftmost first."""
        ids = [*map(self._byte.__getitem__, raw)]
        rank, none = self.ranks.get, len(self.made)
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            ids[k] = self.made[least]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank((ids[k - 1], ids[k]), none)
            if k < len(ranks):
                ranks[k] = rank((ids[k], ids[k + 1]), none)
        return ids

    def _found(self, keys: list[bytes], at: list[int], fragment: Callable[[int], str]) -> list[tuple[int, ...]]:
        """The ids of fragments, each under two hashes of its own, 128 bits; those that weren't met lately are encoded."""
        found = list(map(self._known.get, keys))
        for k, ids in enumerate(found):
            if ids is None:
                ids = self._older.get(keys[k])
                found[k] = ids = self._encoded(fragment(at[k])) if ids is None else ids
                if len(self._known) >= KEPT_FRAGMENTS:
                    self._older, self._known = self._known, {}
                self._known[keys[k]] = ids
        return found

    def _encoded(self, fragment: str) -> tuple[int, ...]:
        """The ids of a fragment; bytes of a character that no token joins cut it further."""
        raw = fragment.encode()
        at = [0, len(raw)]
        if len(raw) > len(fragment):
            b = np.frombuffer(raw, np.uint8)
            at[1:1] = (np.flatnonzero(~self.joined[b[:-1], b[1:]]) + 1).tolist()
        ids: list[int] = []
        for begin, end in zip(at, at[1:], strict=False):
            ids += self._long(raw[begin:end]) if end - begin > 200 else self._merged(raw[begin:end])
        return tuple(ids)

    def _long(self, raw: bytes) -> list[int]:
        """Like ``_merged``, for long runs: a heap of pairs instead of scans."""
        n = len(raw)
        ids: list[int] = [*map(self._byte.__getitem__, raw)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := self.ranks.get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, left, right = heapq.heappop(heap)
            j = after[k]
            if ids[k] != left or j >= n or ids[j] != right:
                continue
            ids[k], ids[j] = self.made[rank], -1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (r := self.ranks.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return [i for i in ids if i >= 0]

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts without special tokens, end to end, and how many each text has."""
        cps = np.concatenate([np.append(code_points(t), np.uint32(END_OF_TEXT)) for t in texts])
        starts = np.flatnonzero(self.cuts(cps))
        ends = np.append(starts[1:], len(cps))
        owner = np.cumsum(cps[starts] == END_OF_TEXT)
        real = cps[starts] != END_OF_TEXT
        starts, ends, owner = starts[real], ends[real], owner[real]
        ids, counts = [], np.zeros(len(texts), np.int64)
        for a, z in stretches(starts, ends):
            begin = int(starts[a])
            own = cps[begin : int(ends[z - 1])]
            s, e = starts[a:z] - begin, ends[a:z] - begin
            h = hashed_spans(own, s, e)
            _, first, which = np.unique(h, return_index=True, return_inverse=True)
            check = hashed_spans(own, s, e, 1)
            raw = own.tobytes()
            fragment = lambda k, s=s, e=e, raw=raw: raw[4 * s[k] : 4 * e[k]].decode("utf-32-le", "surrogatepass")
            if (check[first][which] == check).all() and ((e - s)[first][which] == e - s).all():
                found = self._found(np.stack([h[first], check[first]], axis=1).view("S16").ravel().tolist(), first.tolist(), fragment)
            else:
                # Different fragments of one hash: each is encoded by itself.
                which = np.arange(z - a)
                found = [self._encoded(fragment(k)) for k in which.tolist()]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
            ids.append(_gathered(flat, np.cumsum(sizes) - sizes, sizes, which))
            counts += np.bincount(owner[a:z], sizes[which], len(texts)).astype(np.int64)
        return np.concatenate([*ids, np.zeros(0, np.int32)]), counts

    def encode(self, text: str) -> list[int]:
        return self.encode_flat([text])[0].tolist()

    def _with_specials(self, text: str) -> np.ndarray:
        ids: list[np.ndarray] = []
        while text:
            at, special = min(((k, s) for s in self.special if (k := text.find(s)) >= 0), default=(len(text), ""))
            ids.append(self._plain([text[:at]])[0])
            if special:
                ids.append(np.array([self.special[special]], np.int32))
            text = text[at + len(special) :]
        return np.concatenate([*ids, np.zeros(0, np.int32)])

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and how many each has."""
        ids, counts = [], []
        for _, some in groups(texts):
            if not any(s in t for s in self.special for t in some):
                own, n = self._plain(some)
                ids.append(own)
                counts.append(n)
                continue
            for t in some:
                own = self._with_specials(t)
                ids.append(own)
                counts.append(np.array([len(own)]))
        return np.concatenate([*ids, np.zeros(0, np.int32)]), np.concatenate([*counts, np.zeros(0, np.int64)])

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        ids, counts = self.encode_flat(texts)
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(texts) else []

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, special tokens included; bytes that aren't UTF-8 become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        return _gathered(self._token_bytes, self._token_begins, self._token_sizes, ids).tobytes().decode("utf-8", "replace")


def _gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The pieces of ``flat`` numbered ``which``, end to end."""
    n = sizes[which]
    shift = begins[which] - (np.cumsum(n) - n)
    return flat[np.arange(int(n.sum())) + np.repeat(shift, n)]


@lru_cache(2)
def tokenizer(path: str) -> ForcedBoundaryBpe:
    """One for each worker process and file."""
    return ForcedBoundaryBpe(path)


#: Texts whose ids go on together.
ROWS = 512


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType(), False))])


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, token_ids``: each whole text's ids (null: those of an empty text, none).

    ``path`` is the vocabulary file, present on every executor. One output row
    for each input row, repeated rows and null ids included; long texts are
    encoded whole; an empty table gives an empty one; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in _parts(batches):
            values, sizes = bpe.encode_flat([t or "" for t in batch.column(1).to_pylist()])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            arrays = [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), type=schema.field(2).type)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))).mapInArrow(run, ENCODED)


DECODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])


def decode_texts(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode_texts`` with ``decoded``, the text that their ids give back; null ids give null."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(DECODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in _parts(batches):
            texts = [bpe.decode(ids.values.to_numpy()) if ids.is_valid else None for ids in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.string())], schema=schema)

    return small_batches(encoded.select("doc_id", "n_tokens", "token_ids")).mapInArrow(run, DECODED)
