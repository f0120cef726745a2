"""Language identification by cross-parsing.

Each language's training text is kept as a suffix automaton. A text is parsed
into phrases, each the longest run of characters that occurs somewhere in the
language's text; the language that needs the fewest phrases for the text's
length wins. All texts of a batch are parsed side by side, a character a step,
over the automaton's transitions as one table: where a state has no transition
the phrase ends and the next one begins with that character. The table has the
language's most frequent characters; transitions by the others are few, and are
looked up in a sorted list. A long text is parsed in pieces side by side, as if
each began a phrase; then each piece is parsed again from the state that the piece
before it ends in, until both ways are in one state, from where they agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.store import small_batches
from ledgerline.llm.tokens import code_points, groups, letters
from ledgerline.llm.training import sampling_number

#: Characters of training text of a language, and the texts drawn for them, about.
CHARACTERS = 40_000
TEXTS = 400
#: Characters that have a column of the table: the language's most frequent.
ALPHABET = 63
#: Characters of a long text that are parsed in one piece.
PIECE = 1 << 12
#: Characters of texts that are parsed side by side, about.
TOGETHER = 1 << 22
UNKNOWN = "und"


def clean(text: str | None) -> np.ndarray:
    """The code points of a text in lower case, with each run of what isn't a letter as one blank, none at the ends."""
    cps = letters()[code_points(text or "")]
    letter = np.flatnonzero(cps != 0x20)
    if not len(letter):
        return cps[:0]
    cps = cps[letter[0] : letter[-1] + 1]
    return cps[(cps != 0x20) | np.concatenate([[False], cps[:-1] != 0x20])]


def normalised(text: str) -> str:
    """A cleaned text as a string."""
    return clean(text).tobytes().decode("utf-32-le")


class SuffixAutomaton:
    """All substrings of a sequence of symbols; ``go[state]`` maps a symbol to the state that follows."""

    def __init__(self, symbols: list[int]) -> None:
        self.go: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            new = len(self.go)
            self.go.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in self.go[p]:
                self.go[p][c] = new
                p = link[p]
            if p >= 0:
                q = self.go[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(self.go)
                    self.go.append(dict(self.go[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and self.go[p].get(c) == q:
                        self.go[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new


class Parser:
    """Counts the phrases that texts need by one language's text."""

    def __init__(self, text: str) -> None:
        cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        known, counts = np.unique(cps, return_counts=True)
        known = known[np.lexsort([known, -counts])]
        numbers = np.arange(len(known))
        #: ALPHABET stands for what occurs nowhere in the text, more for the less frequent characters.
        self.symbol = np.full(0x110000, ALPHABET, np.int32)
        self.symbol[known] = numbers + (numbers >= ALPHABET)
        self.symbols = len(known) + 1
        go = SuffixAutomaton(self.symbol[cps].tolist()).go
        width = ALPHABET + 1
        #: Next state's row, with 1 in the lowest bit where a phrase begins with the character.
        table = np.zeros((len(go), width), np.int32)
        first = np.array([go[0].get(c, 0) for c in range(max(width, self.symbols))], np.int32)
        table[:] = first[:width] * width * 2 + 1
        rare: dict[int, int] = {}
        for state, out in enumerate(go):
            for c, to in out.items():
                if c < ALPHABET:
                    table[state, c] = to * width * 2
                else:
                    rare[state * width * self.symbols + c] = to * width * 2 + (state == 0)
        # At the root every character begins a phrase.
        table[0] |= 1
        self.table = table.ravel()
        self.begins = first * width * 2 + 1
        self.rare = np.array(sorted(rare), np.int64)
        self.rare_next = np.array([rare[k] for k in self.rare.tolist()], np.int32)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The table's entries for any characters."""
        reached = self.table[state + np.minimum(symbol, ALPHABET)]
        if len(rare := np.flatnonzero(symbol > ALPHABET)):
            reached[rare] = self.after(state[rare], symbol[rare])
        return reached

    def after(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The table's entries for the less frequent characters."""
        key = state.astype(np.int64) * self.symbols + symbol
        at = np.minimum(np.searchsorted(self.rare, key), len(self.rare) - 1)
        return np.where(self.rare[at] == key, self.rare_next[at], self.begins[symbol])


def _phrase_counts(parsers: list[Parser], texts: list[np.ndarray]) -> np.ndarray:
    """A row for each text, a column for each parser: how many phrases the text needs."""
    pieces, owner = [], []
    for k, cps in enumerate(texts):
        for at in range(0, len(cps), PIECE):
            pieces.append(cps[at : at + PIECE])
            owner.append(k)
    counts = np.zeros((len(texts), len(parsers)), np.int64)
    if not pieces:
        return counts
    sizes, owner = np.array([len(p) for p in pieces]), np.array(owner)
    order = np.argsort(-sizes, kind="stable")
    # One row for each position: the characters of all pieces that are so long, longest piece first.
    longest = int(sizes.max())
    alive = len(pieces) - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")
    begin = np.concatenate([[0], np.cumsum(alive)])
    flat = np.empty(begin[-1], np.uint32)
    for lane, k in enumerate(order.tolist()):
        flat[begin[: sizes[k]] + lane] = pieces[k]
    rows = list(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))
    for column, parser in enumerate(parsers):
        symbols, table = parser.symbol[flat], parser.table
        rare = np.flatnonzero(symbols > ALPHABET)
        by_row = np.searchsorted(rare, begin).tolist()
        others = symbols[rare]
        symbols[rare] = ALPHABET
        state = np.zeros(len(pieces), np.int32)
        found = np.zeros(len(pieces), np.int32)
        for k, (a, b) in enumerate(rows):
            n = b - a
            reached = table[state[:n] + symbols[a:b]]
            if by_row[k] < by_row[k + 1]:
                own = slice(by_row[k], by_row[k + 1])
                reached[rare[own] - a] = parser.after(state[rare[own] - a], others[own])
            found[:n] += reached & 1
            np.right_shift(reached, 1, out=state[:n])
        by_piece, ends = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int32)
        by_piece[order], ends[order] = found, state
        _join_pieces(parser, pieces, owner, by_piece, ends)
        counts[:, column] = np.bincount(owner, by_piece, len(texts))
    return counts


def _join_pieces(parser: Parser, pieces: list[np.ndarray], owner: np.ndarray, counts: np.ndarray, ends: np.ndarray) -> None:
    """Corrects the counts of pieces, and the states that they end in, for what the piece before hands over."""
    due = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    fresh_counts, fresh_ends = counts.copy(), ends.copy()
    while len(due):
        lanes, true, fresh = due, ends[due - 1], np.zeros(len(due), np.int32)
        more = np.zeros(len(due), np.int64)
        later = []
        for k in range(PIECE):
            done = true == fresh
            over = ~done & (np.array([len(pieces[x]) for x in lanes]) <= k)
            counts[lanes[done]] = fresh_counts[lanes[done]] + more[done]
            # A piece that ends first hands on another state than was thought.
            counts[lanes[over]] = fresh_counts[lanes[over]] + more[over]
            later += lanes[over & (ends[lanes] != true)].tolist()
            ends[lanes[over]] = true[over]
            changed = lanes[done & (ends[lanes] != fresh_ends[lanes])]
            later += changed.tolist()
            ends[changed] = fresh_ends[changed]
            going = ~done & ~over
            lanes, true, fresh, more = lanes[going], true[going], fresh[going], more[going]
            if not len(lanes):
                break
            symbol = parser.symbol[np.array([pieces[x][k] for x in lanes])]
            one, two = parser.step(true, symbol), parser.step(fresh, symbol)
            more += (one & 1) - (two & 1)
            true, fresh = one >> 1, two >> 1
        else:
            done = true == fresh
            counts[lanes] = fresh_counts[lanes] + more
            now = np.where(done, fresh_ends[lanes], true)
            later += lanes[ends[lanes] != now].tolist()
            ends[lanes] = now
        after = np.array(sorted(set(later)), np.int64) + 1
        after = after[after < len(pieces)]
        due = after[owner[after] == owner[after - 1]]


class LanguageModel:
    """Parsers of the languages' texts; picks the language of the fewest phrases for the length."""

    def __init__(self, texts: dict[str, str]) -> None:
        self.languages = sorted(texts)
        self.parsers = [Parser(texts[k]) for k in self.languages]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language and a score for each text: the best language's share of the weights 2^(-phrases for a hundred characters). Without a letter, or without a language, it is UNKNOWN with score 0; ties go to the language first by code point."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        cleaned = [clean(t) for t in texts]
        own = [k for k, t in enumerate(cleaned) if len(t)]
        if not self.parsers or not own:
            return out
        counts = _phrase_counts(self.parsers, [cleaned[k] for k in own])
        rates = 100.0 * counts / np.array([[len(cleaned[k])] for k in own])
        best = rates.argmin(axis=1)
        weights = np.exp2(rates.min(axis=1, keepdims=True) - rates)
        scores = 1 / weights.sum(axis=1)
        for k, b, s in zip(own, best.tolist(), scores.tolist(), strict=True):
            out[k] = (self.languages[b], s)
        return out


@lru_cache(2)
def _model(texts: tuple[tuple[str, str], ...]) -> LanguageModel:
    """Built once by each worker process."""
    return LanguageModel(dict(texts))


def training_texts(docs: DataFrame, characters: int = CHARACTERS, texts: int = TEXTS, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """Up to ``characters`` of normalised whole texts for each language, from about ``texts`` of its documents, drawn by a number that follows from the id.

    Rows with a null id, text or language are left out, and so are texts that
    alone would pass the bound; a language that this would leave with nothing
    has a stretch of one of its texts, from the first letter. What comes to the
    driver is bounded by the languages, not by the documents.
    """
    every = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    every = every.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    fits = F.length("text") <= characters
    counts = {r["lang"]: r["n"] for r in every.groupBy("lang").agg(F.count_if(fits).alias("n")).collect()}
    every = every.withColumn("u", sampling_number("doc_id", seed))
    drawn = []
    if any(counts.values()):
        share = F.create_map(*[x for lang, n in sorted(counts.items()) if n for x in (F.lit(lang), F.lit(texts / n))])
        drawn = every.filter(fits & (F.col("u") < F.element_at(share, F.col("lang")))).collect()
    out: dict[str, str] = {}
    for r in sorted(drawn, key=lambda r: (r["u"], r["text"])):
        text = normalised(r["text"])
        if text and len(out.get(r["lang"], "")) + len(text) < characters:
            out[r["lang"]] = f"{out[r['lang']]} {text}" if r["lang"] in out else text
    if bare := sorted(set(counts) - set(out)):
        stretch = F.expr(f"substring(text, regexp_instr(text, '[\\\\p{{L}}]'), {int(characters)})")
        some = every.filter(F.col("lang").isin(bare) & F.col("text").rlike(r"\p{L}")).select("lang", F.struct("u", stretch.alias("text")).alias("one"))
        for r in some.groupBy("lang").agg(F.min("one").alias("one")).collect():
            out[r["lang"]] = normalised(r["one"]["text"])[: characters - 1].strip()
    return {lang: text for lang, text in out.items() if text}


PREDICTED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict_languages(docs: DataFrame, texts: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for each input row, over its whole text, null ids and repeated rows included; null texts and those without a letter are UNKNOWN with score 0, and so is all without a learned language. An empty table gives an empty one; other columns are not read. Only the languages' training texts go to the executors."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(sorted(texts.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent.value)
        for batch in batches:
            found = [f for _, texts in groups(batch.column(1).to_pylist(), TOGETHER) for f in model.predict(texts)]
            arrays = [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score"])

    return small_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))).mapInArrow(run, PREDICTED)
