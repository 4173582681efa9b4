"""SentencePiece encoding and decoding for merge-type vocabularies.

``PieceCodec`` reads pieces, scores and types from a model file and encodes by a score-ordered agenda of adjacent
symbol pairs: the pair whose piece has the highest score (leftmost at a tie) is merged first, and stale entries
are skipped. Where no piece joins a character to a following space mark, texts split before each run of space
marks and around line feeds without changing the result, so each distinct chunk runs through the agenda once and
is then kept in a bounded cache. Symbols outside the vocabulary become byte pieces.

All new chunks of a pass, of whatever length, share one agenda of arrays (``Agenda``), which gives out all places of
the best score at once. Chunks don't touch each other, so each of them sees its own pairs in the order of its scores. A
merge that makes a pair of the same or a better score than its own would have to come first; a vocabulary made by
merging never does that (whatever a piece is made of was merged before it), but one that was cut may. Such a chunk is
encoded again by ``PieceCodec.agenda``, which takes one entry at a time.

In every pass all chunks that are new to the worker are encoded by the sentencepiece library as well, and so is every
whole text whose crc32 is divisible by ``WHOLE``; a difference raises. ``check="texts"`` compares all whole texts
instead. Decoding is the library's ``decode``.

Null texts count as empty: they have the begin and end ids only. Texts are never cut. Repeated rows give equal
values; an empty table gives an empty result; no other column is read, and extra ones are dropped.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import operator
import re
import struct
import zlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import arrow_map, prepare, table

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Distinct chunks that a worker keeps, and the characters of the longest that it keeps.
CACHE, CACHE_CHARS = 400_000, 64
#: Characters of texts that go through the agenda together; a longer text is alone.
PASS_CHARS = 4_000_000
#: Of this many whole texts about one is compared with the library, besides all new chunks.
WHOLE = 32
NEVER = np.int32(1 << 30)
CHUNK = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def little(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Merges:
    """The piece that two symbols make and its rank, by a hash table of arrays; its last slot is for pairs that make none."""

    FREE = np.int64(-1 << 62)

    def __init__(self, keys: np.ndarray, pieces: np.ndarray, ranks: np.ndarray):
        size = 1 << max(10, (8 * len(keys)).bit_length())
        self.mask = np.int64(size - 1)
        self.key = np.full(size, self.FREE)
        self.piece, self.rank = np.full(size, -1, dtype=np.int32), np.full(size, NEVER)
        todo, place = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = np.flatnonzero(self.key[place] == self.FREE)
            put = free[np.unique(place[free], return_index=True)[1]]  # one key for each free slot, the others go on
            self.key[place[put]], self.piece[place[put]], self.rank[place[put]] = keys[todo[put]], pieces[todo[put]], ranks[todo[put]]
            todo, place = np.delete(todo, put), (np.delete(place, put) + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.int64(-7046029254386353131)) >> np.int64(40)) & self.mask

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slots of pairs of symbols."""
        key = (a.astype(np.int64) << 32) | b
        at = self._slot(key)
        found = self.key[at]
        left = np.flatnonzero((found != key) & (found != self.FREE))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found = self.key[at[left]]
            left = left[(found != key[left]) & (found != self.FREE)]
        return at


class Agenda:
    """Places by rank, the best rank first. Ranks that are far off wait in coarse buckets; one that is opened is sorted by rank. Ranks are under 2 ** 22."""

    COARSE = 6

    def __init__(self) -> None:
        self.far: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.near: dict[int, list[tuple[np.ndarray]]] = {}
        self.far_order: list[int] = []
        self.near_order: list[int] = []
        self.open = -1

    @staticmethod
    def _put(into: dict, order: list[int], by: np.ndarray, *values: np.ndarray) -> None:
        sort = np.argsort(by.astype(np.uint16), kind="stable")  # of 16 bits numpy sorts by digits
        by, values = by[sort], tuple(v[sort] for v in values)
        edges = [0, *(np.flatnonzero(by[1:] != by[:-1]) + 1).tolist(), len(by)]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            key = int(by[lo])
            if key not in into:
                into[key] = []
                heappush(order, key)
            into[key].append(tuple(v[lo:hi] for v in values))

    def push(self, places: np.ndarray, ranks: np.ndarray) -> None:
        bucket = ranks >> self.COARSE
        here = bucket == self.open
        if here.any():
            self._put(self.near, self.near_order, ranks[here] & ((1 << self.COARSE) - 1), places[here])
            places, ranks, bucket = places[~here], ranks[~here], bucket[~here]
        if len(places):
            self._put(self.far, self.far_order, bucket, places, ranks)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The best rank and the places that were entered with it."""
        if not self.near_order:
            if not self.far_order:
                return None
            self.open = heappop(self.far_order)
            places, ranks = (np.concatenate(x) for x in zip(*self.far.pop(self.open), strict=True))
            self._put(self.near, self.near_order, ranks & ((1 << self.COARSE) - 1), places)
        low = heappop(self.near_order)
        return (self.open << self.COARSE) + low, np.concatenate([x for (x,) in self.near.pop(low)])


class PieceCodec:
    def __init__(self, path: str, check: str = "chunks", most: int | None = None):
        """``most``: chunks that are kept, ``CACHE`` by default."""
        import sentencepiece

        if check not in ("chunks", "texts", "none"):
            raise ValueError(f"not a check: {check!r}")
        self.check, self.most = check, most or CACHE
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.id = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in self.id.values()}, reverse=True))}
        self.rank = {p: order[sp.get_score(i)] for p, i in self.id.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.bytes):
            raise ValueError("the vocabulary has no byte pieces")
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in self.id):
            raise ValueError("a piece crosses the chunks' edges")
        self.bos, self.eos = (np.array([i], dtype="<u4").tobytes() for i in (sp.bos_id(), sp.eos_id()))
        self.cache: dict[str, bytes] = {}
        self._learn()

    def _learn(self) -> None:
        cuts = [(self.id[p[:i]], self.id[p[i:]], p) for p in self.id for i in range(1, len(p)) if p[:i] in self.id and p[i:] in self.id]
        self.merges = Merges(np.array([a << 32 | b for a, b, _ in cuts], dtype=np.int64), np.array([self.id[p] for *_, p in cuts], dtype=np.int32), np.array([self.rank[p] for *_, p in cuts], dtype=np.int32))
        self.of_code = -np.arange(2, 0x110002, dtype=np.int32)  # a character without a piece is the negative of its code point, less two
        for p, i in self.id.items():
            if len(p) == 1:
                self.of_code[ord(p)] = i

    def agenda(self, chunk: str) -> list[int]:
        """The ids of one chunk.

        An entry is one number: the rank of a pair's piece times the chunk's length, plus the place of its left symbol.
        It is stale if the symbols that stand there now make another piece or none.
        """
        get, n = self.rank.get, len(chunk)
        symbols: list[str | None] = list(chunk)
        heap = [r * n + i for i, pair in enumerate(map(operator.add, chunk, chunk[1:])) if (r := get(pair)) is not None]
        if heap:
            heapq.heapify(heap)
            left, right = list(range(-1, n - 1)), list(range(1, n + 1))
            while heap:
                r, i = divmod(heappop(heap), n)
                j = right[i]
                if symbols[i] is None or j >= n:
                    continue
                piece = symbols[i] + symbols[j]
                if get(piece) != r:
                    continue
                symbols[i], symbols[j] = piece, None
                right[i] = k = right[j]
                if k < n:
                    left[k] = i
                    r = get(piece + symbols[k])
                    if r is not None:
                        heappush(heap, r * n + i)
                h = left[i]
                if h >= 0:
                    r = get(symbols[h] + piece)
                    if r is not None:
                        heappush(heap, r * n + h)
        ids = [self.id.get(x) for x in symbols if x is not None]
        if None in ids:
            ids = [i for x in symbols if x is not None for i in ([self.id[x]] if x in self.id else [self.bytes[b] for b in x.encode()])]
        return ids

    def agendas(self, chunks: list[str]) -> list[bytes]:
        """The ids of many chunks through one agenda, little-endian unsigned 32-bit integers.

        ``symbol`` has a symbol (or ``GONE``) for each character's place, ``after`` and ``before`` are its neighbours' places
        (``n`` where there is none), ``rank`` and ``piece`` what it makes with the next one. An entry is stale if its rank is
        no longer that of its place.
        """
        if not chunks:
            return []
        gone, merges, agenda = np.int32(-0x7FFFFFFF), self.merges, Agenda()
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        n, last = int(lengths.sum()), np.cumsum(lengths) - 1
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbol = np.append(self.of_code[codes], gone)
        kind = np.int32 if n < 2**31 - 2 else np.int64
        after, before = np.arange(1, n + 2, dtype=kind), np.arange(-1, n, dtype=kind)
        after[last], after[n], before[last - lengths + 1] = n, n, n
        at = merges.find(symbol, symbol[after])
        rank, piece = merges.rank[at], merges.piece[at]
        start = np.flatnonzero(rank < NEVER).astype(kind)
        agenda.push(start, rank[start])
        odd: list[np.ndarray] = []
        while (entry := agenda.pop()) is not None:
            now, i = entry
            i = np.sort(i[rank[i] == now])
            i = i[np.concatenate(([True], i[1:] != i[:-1]))] if len(i) else i
            if not len(i):
                continue
            linked = after[i[:-1]] == i[1:]
            if linked.any():  # of pairs that share a symbol the left one is merged, then the next that is still whole
                number = np.arange(len(i))
                first = np.maximum.accumulate(np.where(np.concatenate(([True], ~linked)), number, 0))
                i = i[(number - first) % 2 == 0]
            j, made = after[i], piece[i]
            k = after[j]
            beside = np.flatnonzero(k[:-1] == i[1:])
            if len(beside):  # the right neighbour, merged in the same step, was still as before when this pair was made
                odd.append(i[beside[merges.rank[merges.find(made[beside], symbol[k[beside]])] <= now]])
            symbol[i], symbol[j], rank[j], after[i], before[k] = made, gone, NEVER, k, i
            left = before[i]
            changed = np.concatenate((i, left[left < n]))
            at = merges.find(symbol[changed], symbol[after[changed]])
            rank[changed], piece[changed] = merges.rank[at], merges.piece[at]
            odd.append(changed[rank[changed] <= now])
            changed = changed[(rank[changed] < NEVER) & (rank[changed] > now)]
            if len(changed):
                agenda.push(changed, rank[changed])
        there = symbol[:n] != gone
        ends, ids = np.cumsum(there)[last], symbol[:n][there]
        outside = np.flatnonzero(ids < 0)
        if len(outside):
            sizes = np.ones(len(ids), dtype=np.int64)
            codes, which = np.unique(ids[outside], return_inverse=True)
            spelled = [[self.bytes[b] for b in chr(-2 - c).encode("utf-8", "surrogatepass")] for c in codes.tolist()]
            sizes[outside] = np.array([len(x) for x in spelled])[which]
            begin = np.cumsum(sizes) - sizes
            ends, ids = np.append(begin, sizes.sum())[ends], np.repeat(ids, sizes)
            for c, x in enumerate(spelled):
                ids[begin[outside[which == c]][:, None] + np.arange(len(x))] = x
        flat, ends = ids.astype("<u4").tobytes(), ends.tolist()
        out = [flat[4 * lo : 4 * hi] for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]
        for c in np.unique(np.searchsorted(last, np.concatenate([np.zeros(0, np.int64), *odd]))).tolist():
            out[c] = little(self.agenda(chunks[c]))
        return out

    def _verify(self, chunks: list[str], ids: list[bytes]) -> None:
        """Each chunk alone: the library puts a space mark before a text, so a chunk without one is set apart by a line feed."""
        feed = little(self.library.encode("\n"))
        texts = [c[1:].replace(SPACE, " ") if c[0] == SPACE else "\n" + c for c in chunks]
        others = self.library.encode(texts, num_threads=1)
        own = [(x if len(c) > 1 else b"") if c[0] == SPACE else feed + x for c, x in zip(chunks, ids, strict=True)]
        self._same(chunks, own, others)

    @staticmethod
    def _same(texts: list[str], own: list[bytes], others: list[list[int]]) -> None:
        flat = np.fromiter(itertools.chain.from_iterable(others), dtype="<u4").tobytes()
        if flat == b"".join(own) and [4 * len(x) for x in others] == [len(x) for x in own]:
            return
        for t, x, y in zip(texts, own, others, strict=True):
            if x != little(y):
                raise ValueError(f"the agenda and the library differ on {t[:200]!r}")

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """For each text its ids with begin and end, as little-endian unsigned 32-bit integers."""
        cache = self.cache
        split = [CHUNK.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = list(set().union(*split).difference(cache))
        ids = self.agendas(new)
        if self.check == "chunks":
            self._verify(new, ids)
        now = dict(zip(new, ids, strict=True))
        if len(cache) + len(now) > self.most:
            old, cache = cache, {}
            now |= {c: old[c] for chunks in split for c in chunks if c in old}
            self.cache = cache
        cache.update(now)
        out = [b"".join([self.bos, *map(cache.__getitem__, chunks), self.eos]) for chunks in split]
        for c in [c for c in now if len(c) > CACHE_CHARS]:
            del cache[c]
        whole = [] if self.check == "none" else [i for i, t in enumerate(texts) if self.check == "texts" or zlib.crc32(t.encode()) % WHOLE == 0]
        given = [texts[i] for i in whole]
        self._same(given, [out[i] for i in whole], self.library.encode(given, num_threads=1, add_bos=True, add_eos=True))
        return out

    def decode_batch(self, ids: list[bytes]) -> list[str]:
        return self.library.decode([np.frombuffer(x, dtype="<u4").tolist() for x in ids], num_threads=1) if ids else []


_codecs: dict[tuple[str, str, int], PieceCodec] = {}


def codec(path: str, check: str, most: int = CACHE) -> PieceCodec:
    if (path, check, most) not in _codecs:
        _codecs[path, check, most] = PieceCodec(path, check, most)
    return _codecs[path, check, most]


def joined(batches: Iterator[pa.RecordBatch], most: int = PASS_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of many batches, in passes that hold at most ``most`` characters together; a longer text is alone."""
    ids: list[pa.Array] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        start = 0
        given = [t or "" for t in batch.column(1).to_pylist()]
        for i, t in enumerate(given):
            if size and size + len(t) > most:
                yield pa.concat_arrays([*ids, batch.column(0).slice(start, i - start)]), texts + given[start:i]
                ids, texts, size, start = [], [], 0, i
            size += len(t)
        ids.append(batch.column(0).slice(start))
        texts += given[start:]
    if texts:
        yield pa.concat_arrays(ids), texts


#: What ``encode_pieces`` can give for a text, besides its id.
OUTPUTS = {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()), "n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")


def _output(name: str, ids: list[bytes], decoded: list[str]) -> pa.Array:
    if name == "ids":
        offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
    if name == "n_tokens":
        return pa.array([len(x) // 4 for x in ids], pa.int64())
    if name == "decoded":
        return pa.array(decoded, pa.string())
    return pa.array([hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest() for x in (ids if name == "ids_sha256" else decoded)], pa.string())


def encode_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, check: str = "chunks", outputs: tuple[str, ...] = ("ids", "decoded"), chars: int = PASS_CHARS, chunks: int = CACHE) -> DataFrame:
    """``id_col`` and ``outputs`` (see ``OUTPUTS``) for every row; ids have begin and end.

    ``chars`` of texts go through the agenda together and ``chunks`` distinct chunks are kept: less of both takes less of a worker's memory and more time.
    """
    path = model or MODEL
    prepare(df.sparkSession)
    given = df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        c = codec(path if "/" in path else model_path(path), check, chunks)
        for keys, texts in joined(batches, chars):
            ids = c.encode_batch(texts)
            decoded = c.decode_batch(ids)
            yield [keys, *(_output(x, ids, decoded) for x in outputs)]
        c.cache.clear()  # a worker that waits for other tasks holds no chunks

    return arrow_map(given, run, [(id_col, given.schema.fields[0].dataType), *((x, OUTPUTS[x][0]) for x in outputs)])


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), outputs=DIGESTS)


QUERIES = {"op10_pieces": op10_pieces}
ORACLES: dict[str, str] = {}
