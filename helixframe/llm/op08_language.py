"""Language ID by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed greedily into the longest phrases
that occur in the labelled text; the language that needs the fewest phrases, normalised by the information in a
pointer into its labelled text (phrases x log2 of its length / characters), wins. Ties go to the first language by
name.

Texts are lower-cased, and runs of other characters than letters and marks become one space. So that all parts of a batch
advance together, one character at a step, texts are first parsed in blocks of ``BLOCK`` characters; then each later block
is parsed again from the state in which the one before ends, up to the place where both parses are in the same state, from
which they agree. The phrases are those of one parse of the whole text. A step goes through a flat transition
table of each language in which a missing transition holds the state of a new phrase that begins with the symbol, and
a flag that counts it. Each language keeps all code points of its labelled text: its most frequent ones are columns of
the table, and transitions by the others are looked up in a sorted list. Only what its text lacks matches nothing.

The model is fitted on a bounded sample of labelled rows: for each language the rows of the training fold with the
smallest hash, at most ``DOCS`` rows and ``CHARS`` characters. The tables of all languages together, which are broadcast, have
at most ``MODEL_BYTES``: with so many languages that they would not, each has fewer characters. Everything else reads every row.

``in_known_languages`` keeps the rows whose text is in a learned language. Its measure is the phrases completed, in the
same normalisation (the last isn't, so a text of one phrase costs nothing). For each language half of the
labelled texts are parsed with the other half, both ways, as they are and with their letters shuffled; a text goes if in
every language it costs more than a shuffled text (the median) and more than the dearest labelled one. Texts of several
learned languages are within the bound. Texts with letters stay where too little was learned to tell: all of them while
no language has a full sample (``DOCS`` texts or ``CHARS`` characters), and those nearest to a language with one text.

Null texts and texts without a letter (marks and digits are none) get ``und`` and score 0, and teach nothing. With no
labelled row at all, every text gets ``und``. Very long texts are parsed whole; repeated rows are predicted alike; an empty
table gives an empty result. Columns that are kept may have any name but those of ``out``, which raise.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .kernels import passes
from .session import arrow_map, fold, prepare, table

#: Bounds of the labelled sample, for each language.
DOCS, CHARS = 48, 32_000
#: Symbols of a language with a column of the transition table; transitions by its rarer ones are in a sorted list.
SYMBOLS = 127
MODEL_BYTES = 192 << 20
#: Characters that are first parsed on their own, and rounds in which all blocks are parsed again before the texts that are left go one block after the other.
BLOCK, ROUNDS = 512, 4
#: Languages whose parses advance together, and characters of a pass (about 50 bytes each, and eight more for each of these languages).
TOGETHER, PASS_CHARS = 8, 1_000_000
UNKNOWN = "und"


@functools.cache
def letters(kinds: str = "LM") -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    for i in range(0x110000):
        table[i] = unicodedata.category(chr(i))[0] in kinds
    return table


def normal(text: str) -> np.ndarray:
    """Code points of the lower-cased text, with each run of other characters as one space and none at the ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[codes]
    codes = np.where(is_letter, codes, 32)
    gap = ~is_letter
    keep = ~(gap & np.concatenate(([True], gap[:-1])))
    codes = codes[keep]
    return codes[:-1] if len(codes) and codes[-1] == 32 else codes


def readable(text: str | None) -> np.ndarray:
    """``normal``, but nothing for a text without a letter."""
    codes = normal(text) if text else np.zeros(0, np.uint32)
    return codes if letters("L")[codes].any() else codes[:0]


def automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton; state 0 is the start."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sequence:
        new = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = new
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return to


@dataclass
class Parser:
    """The automata of some languages in one table, so that their parses advance together.

    ``table``: for row x width + symbol, twice the next row's start, plus one where a phrase begins with the
    symbol; each language has rows of its own from ``roots`` on. ``keys`` and ``values``: the same for row x rare symbols + rare symbol, sorted, where there is such a
    transition; ``begins`` has the phrases that begin with each rare symbol. ``symbols``: for each language, by place in the alphabet of
    all languages + 1, a column of the table, or width + rare symbol, or 0 for what its text lacks.
    """

    symbols: np.ndarray
    width: int
    table: np.ndarray
    roots: np.ndarray
    keys: np.ndarray
    values: np.ndarray
    begins: np.ndarray

    @classmethod
    def fit(cls, texts: list[np.ndarray], alphabet: np.ndarray) -> Parser:
        codes = []
        for text in texts:
            code, count = np.unique(text[text > 0], return_counts=True)
            codes.append(code[np.lexsort((code, -count))])
        width = min(max(map(len, codes)), SYMBOLS) + 1
        rare = [max(0, len(c) + 1 - width) for c in codes]
        symbols = np.zeros((len(texts), len(alphabet) + 1), dtype=np.int64)
        begins, tables, keys, values, roots, rows, before = np.zeros(sum(rare), dtype=np.int64), [], [], [], [], 0, 0
        for row, (text, code) in enumerate(zip(texts, codes, strict=True)):
            own = np.arange(1, len(code) + 1)
            symbols[row, np.searchsorted(alphabet, code) + 1] = np.where(own < width, own, own + before)
            place = np.where(text > 0, np.searchsorted(alphabet, text) + 1, 0)
            states = automaton(np.where(text > 0, symbols[row, place], -np.arange(1, len(text) + 1)).tolist())  # a symbol of its own that no text has
            root = np.full(width, 2 * rows * width + 1, dtype=np.int64)
            for c, q in states[0].items():
                if c >= width:
                    begins[c - width] = 2 * (rows + q) * width + 1
                elif c > 0:
                    root[c] = 2 * (rows + q) * width + 1
            table = np.tile(root, (len(states), 1))  # the first row begins a phrase with any symbol
            for i, edges in enumerate(states[1:], 1):
                for c, q in edges.items():
                    if c >= width:
                        keys.append((rows + i) * len(begins) + c - width)
                        values.append(2 * (rows + q) * width)
                    elif c > 0:
                        table[i, c] = 2 * (rows + q) * width
            tables.append(table)
            roots.append(rows * width)
            rows += len(states)
            before += rare[row]
        table = np.concatenate(tables).ravel()
        order = np.argsort(np.array(keys, dtype=np.int64))
        kind = np.int32 if 2 * table.size < 2**31 else np.int64
        return cls(symbols.astype(kind), width, table.astype(kind), np.array(roots, dtype=kind), np.array(keys, dtype=np.int64)[order], np.array(values, dtype=kind)[order], begins.astype(kind))

    @staticmethod
    def size(texts: list[np.ndarray]) -> int:
        """Bytes of the table at most."""
        return 8 * sum(map(len, texts)) * (min(max((len(np.unique(t)) for t in texts), default=0), SYMBOLS) + 1)

    def parse(self, symbol: np.ndarray, start: np.ndarray, length: np.ndarray, owner: np.ndarray, root: np.ndarray) -> np.ndarray:
        """Twice the row after each character, plus one where a phrase begins with it; blocks of one ``owner`` follow each other in one parse, which starts in its ``root``."""
        steps = np.zeros(len(symbol), dtype=self.table.dtype)
        order = np.argsort(-length, kind="stable")
        at, ends, state = start[order], -length[order], root[order]
        for t in range(int(length.max())):
            k = np.searchsorted(ends, -t, side="left")
            now = at[:k] + t
            step = self.step(state[:k], symbol.take(now))
            steps[now] = step
            state[:k] = step >> 1
        later = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        stop = start + length
        for _ in range(ROUNDS):
            if not len(later):
                return steps
            met = self._again(symbol, steps, start[later], stop[later])[1]
            later = later[~met] + 1
            later = later[later < len(owner)]
            later = later[owner[later] == owner[later - 1]]
        last = np.zeros(int(owner.max()) + 1, dtype=np.int64)
        last[owner] = stop  # of each text
        while len(later):
            lead = later[np.unique(owner[later], return_index=True)[1]]
            last_seen = np.zeros_like(last)
            last_seen[owner[lead]] = self._again(symbol, steps, start[lead], last[owner[lead]])[0]
            later = later[start[later] >= last_seen[owner[later]]]
        return steps

    def _again(self, symbol: np.ndarray, steps: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parses from each place on in the state before it, until the states are the old ones; where that was, and whether it was before ``stop``."""
        at, met = at.copy(), np.zeros(len(at), dtype=bool)
        live, state = np.arange(len(at)), steps[at - 1] >> 1
        while len(live):
            now = at[live]
            step, old = self.step(state, symbol.take(now)), steps[now]
            steps[now] = step
            same = (step >> 1) == (old >> 1)
            met[live[same]] = True
            at[live] += 1
            on = ~same & (at[live] < stop[live])
            live, state = live[on], (step >> 1)[on]
        return at, met

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        if not len(self.begins):
            return self.table.take(state + symbol)
        rare = np.flatnonzero(symbol >= self.width)
        out = self.table.take(state + np.where(symbol < self.width, symbol, 0))
        if len(rare):
            which = symbol[rare] - self.width
            found = self.begins[which]
            if len(self.keys):
                key = (state[rare] // self.width).astype(np.int64) * len(self.begins) + which
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = np.where(self.keys[at] == key, self.values[at], found)
            out[rare] = found
        return out


@dataclass
class LanguageModel:
    """``alphabet``: all code points of the labelled texts, sorted. ``bounds``: the most that a text in each language may cost."""

    languages: list[str]
    alphabet: np.ndarray
    parsers: list[Parser]
    bits: np.ndarray
    bounds: np.ndarray | None = None

    @classmethod
    def fit(cls, samples: dict[str, list[str]], chars: int = CHARS) -> LanguageModel:
        languages = sorted(samples)
        texts = {k: cls._sample(samples[k], chars) for k in languages}
        size = Parser.size(list(texts.values()))
        if size > MODEL_BYTES:
            texts = {k: t[: max(1, len(t) * MODEL_BYTES // size)] for k, t in texts.items()}
        languages = [k for k in languages if len(texts[k])]
        if not languages:
            return cls([], np.zeros(0, np.uint32), [], np.zeros(0))
        alphabet = np.unique(np.concatenate([texts[k][texts[k] > 0] for k in languages]))
        parsers = [Parser.fit([texts[k] for k in languages[lo : lo + TOGETHER]], alphabet) for lo in range(0, len(languages), TOGETHER)]
        return cls(languages, alphabet, parsers, np.array([math.log2(max(2, len(texts[k]))) for k in languages]))

    @staticmethod
    def _sample(texts: list[str], chars: int) -> np.ndarray:
        parts, size = [], 0
        for t in texts:
            codes = readable(t)[: chars - size]
            if len(codes):
                parts += [codes, np.array([0], dtype=np.uint32)]  # nothing matches across texts
                size += len(codes)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)

    @classmethod
    def bounded(cls, samples: dict[str, list[str]], docs: int = DOCS, chars: int = CHARS) -> LanguageModel:
        model, rng = cls.fit(samples, chars), np.random.default_rng(0)
        model.bounds = np.full(len(model.languages), np.inf)
        if not any(len(v) >= docs or sum(len(readable(t)) for t in v) >= chars for v in samples.values()):
            return model
        halves = [{k: v[i::2] for k, v in samples.items()} for i in (0, 1)]
        found: dict[str, list[np.ndarray]] = {k: [] for k in model.languages}
        for learned, other in (halves, halves[::-1]):
            half = cls.fit(learned, chars)
            for j, k in enumerate(half.languages):
                texts = [t for t in other[k] if len(readable(t))]
                mixed = ["".join(map(chr, rng.permutation(readable(t)))) for t in texts]
                found[k].append(np.stack([half.costs(x)[0][:, j] for x in (texts, mixed)]))
        for j, costs in enumerate(found.values()):
            if sum(c.shape[1] for c in costs):
                own, mixed = np.concatenate(costs, axis=1)
                model.bounds[j] = max(own.max(), np.median(mixed))
        return model

    def costs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character of completed phrases by text and language, and characters by text."""
        count, sizes = self.phrases(texts)
        return np.maximum(count - 1, 0) * self.bits / np.maximum(sizes, 1)[:, None], sizes

    def accepts(self, texts: list[str | None]) -> np.ndarray:
        """Whether each text has a letter and is within the bound of a language, or its nearest language has none."""
        cost, sizes = self.costs(texts)
        if not self.languages:
            return sizes > 0
        near = np.isinf(self.bounds)[cost.argmin(axis=1)]
        return (sizes > 0) & (near | ((cost <= self.bounds) & np.isfinite(self.bounds)).any(axis=1))

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by text and language, and characters by text (none for a text without a letter)."""
        codes = [readable(t) for t in texts]
        sizes = np.array([len(c) for c in codes], dtype=np.int64)
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        if not len(owner) or not self.languages:
            return out, sizes
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        length = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
        flat = np.concatenate(codes)
        first = np.cumsum(sizes) - sizes
        place = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        place = np.where(self.alphabet[place] == flat, place + 1, 0)
        full = np.flatnonzero(sizes)
        for number, p in enumerate(self.parsers):
            each, n = len(p.symbols), len(flat)
            spread = lambda x, step: (x + np.arange(each)[:, None] * step).ravel()  # noqa: B023, E731  the blocks of all languages, one language after the other
            steps = p.parse(p.symbols.take(place, axis=1).ravel(), spread(first[owner] + nth * BLOCK, n), np.tile(length, each), spread(owner, len(texts)), np.repeat(p.roots, len(owner)))
            out[full, number * TOGETHER : number * TOGETHER + each] = np.add.reduceat(steps & 1, spread(first[full], n), dtype=np.int64).reshape(each, -1).T
        return out, sizes

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language, and by what share it needs less than the runner-up (1 if there is none)."""
        count, sizes = self.phrases(texts)
        out = []
        for c, n in zip(count, sizes, strict=True):
            if not n or not self.languages:
                out.append((UNKNOWN, 0.0))
                continue
            cost = c * self.bits / n
            order = np.argsort(cost, kind="stable")
            out.append((self.languages[order[0]], float(1 - cost[order[0]] / cost[order[1]]) if len(order) > 1 else 1.0))
        return out


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int = DOCS) -> dict[str, list[str]]:
    """For each language the texts of the rows with the smallest id hash. The ids are chosen before any text is read."""
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    small = given.filter(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id").cast("string")), "id"))
    chosen = small.select("id", "lang").withColumn("__n", rank).filter(F.col("__n") <= docs_per_lang).collect()
    if not chosen:
        return {}
    rows = small.filter(F.col("id").isin([r[0] for r in chosen])).select("id", "lang", F.substring("text", 1, CHARS).alias("text")).groupBy("id", "lang").agg(F.min("text")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[2])):
        out.setdefault(r[1], []).append(r[2])
    return out


def predict_language(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None, out: tuple[str, str] = ("lang_pred", "score"), docs_per_lang: int = DOCS, chars: int = CHARS) -> DataFrame:
    """The language and its score, named by ``out``, for every row of ``docs``; learned from the rows of ``train`` that have a language.

    ``keep`` names the columns of ``docs`` that stay (the id alone if not given).
    """
    spark = prepare(docs.sparkSession)
    model = LanguageModel.fit(labelled_sample(train, id_col, text_col, lang_col, docs_per_lang), chars)
    shared = spark.sparkContext.broadcast(model)
    keep = [id_col] if keep is None else keep
    if clash := {c.lower() for c in keep} & {c.lower() for c in out}:
        raise ValueError(f"columns with an output's name: {sorted(clash)}")
    given = docs.select(F.col(f"`{text_col}`"), *(F.col(f"`{c}`") for c in keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in passes(texts, PASS_CHARS):
                seen = shared.value.predict(texts[lo:hi])
                yield [*batch.slice(lo, hi - lo).columns[1:], pa.array([s[0] for s in seen], pa.string()), pa.array([s[1] for s in seen], pa.float64())]

    return arrow_map(given, run, [*((f.name, f.dataType) for f in given.schema.fields[1:]), (out[0], "string"), (out[1], "double")])


def in_known_languages(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS, chars: int = CHARS) -> DataFrame:
    """The rows of ``docs`` whose text is in a language learned from the rows of ``train``."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(LanguageModel.bounded(labelled_sample(train, id_col, text_col, lang_col, docs_per_lang), docs_per_lang, chars))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for lo, hi in passes(texts, PASS_CHARS):
                yield batch.slice(lo, hi - lo).filter(pa.array(shared.value.accepts(texts[lo:hi]))).columns

    return arrow_map(docs, run, [(f.name, f.dataType) for f in docs.schema.fields])


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict_language(docs, docs.filter(fold("doc_id", 4) != 2))
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op8_language": op8_language}
ORACLES: dict[str, str] = {}
