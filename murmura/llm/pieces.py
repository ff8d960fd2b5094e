"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is escaped the usual way (a space mark in front, spaces as space marks) and every character is a
symbol. The agenda holds the neighbouring pairs that form a piece, best score first, then leftmost; a pair
whose turn comes is skipped for good when its keyed hash falls below the dropout rate. The key is the seed,
the doc_id, the word's number in the text and the pair's place in the word, so a run repeats exactly, and every
occurrence of a word has draws of its own. A rate of 0 gives the plain segmentation.

No piece crosses a word boundary (a space mark after another character, a line feed) or a pair of characters
that no piece contains, so texts are cut there. The draws of an occurrence for all pairs that its word can ever
offer decide its pieces; occurrences of a word with equal draws are encoded once a slice. Short words
go through their agendas together, one numpy step for all; long ones have a heap each.

Decoding joins the pieces' bytes and is exact for every text: characters without a piece, and the space mark
itself when it stands in a text, are written as bytes.

The vocabulary is read on the driver from a model file (a parameter) and sent to the tasks.

Cases: a null text gives null pieces, an empty one none; decoding gives them back. A null doc_id counts as
the empty string in the hash. Repeated rows get the same pieces; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import mix64, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE, SEED = 0.1, 17
MARK, LITERAL = "▁", "\udfff"  # the space mark, and what stands for one in a text
SHORT = 40  # symbols; longer words take the heap
CACHE = 250_000  # words whose possible merges are kept
DRAWS, WORDS = 39, 24  # bits for the draws and for the number of a word where occurrences are compared
OFTEN = 16  # occurrences in a slice from which on comparing costs less than encoding each
_NONE = np.int32(2**31 - 1)
_CUT = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]  # 0 piece, 1 byte, 2 control or unknown

    @staticmethod
    def load(path: str = MODEL) -> "Vocabulary":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        return Vocabulary(
            [sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n],
            [1 if sp.is_byte(i) else 2 if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else 0 for i in n],
        )


class Codec:
    """Encodes and decodes with one vocabulary, dropout rate and seed."""

    def __init__(self, vocabulary: Vocabulary, rate: float = RATE, seed: int = SEED):
        self.rate, self.seed = rate, seed
        v = vocabulary
        self.ids = {p: i for i, p in enumerate(v.pieces) if v.kinds[i] == 0}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(v.pieces) if v.kinds[i] == 1}
        self.joined = [
            bytes([int(p[3:5], 16)]) if v.kinds[i] == 1 else p.replace(MARK, " ").encode() if v.kinds[i] == 0 else b""
            for i, p in enumerate(v.pieces)
        ]
        self.rank = np.full(len(v.pieces), _NONE, np.int32)
        for at, i in enumerate(sorted(self.ids.values(), key=lambda i: (-v.scores[i], i))):
            self.rank[i] = at
        self.merges: dict[int, int] = {}
        self.near: set[str] = set()
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                self.near.add(piece[cut - 1 : cut + 1])
                if left is not None and right is not None:
                    self.merges[left << 20 | right] = i
        self.by_code = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.by_code[ord(p)] = i
        self._table()
        self.limit = np.uint64(min(int(rate * 2**64), 2**64 - 1))
        made = set(self.merges.values())
        self.made = {p: i for p, i in self.ids.items() if i in made}
        self.longest = max(map(len, self.made), default=0)
        self.cache: dict[str, list[int]] = {}

    def _table(self) -> None:
        """The merges as two hash tables (a key lost to a collision in the first goes to the second) and a rest."""
        keys = np.array(list(self.merges), np.uint64)
        values = np.array(list(self.merges.values()), np.int32)
        self.tables = []
        for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            at = keys * np.uint64(factor) >> np.uint64(64 - 20)
            slot, value = np.full(1 << 20, 2**63, np.uint64), np.zeros(1 << 20, np.int32)
            slot[at], value[at] = keys, values
            self.tables.append((np.uint64(factor), slot, value))
            lost = slot[at] != keys
            keys, values = keys[lost], values[lost]
        order = np.argsort(keys)
        self.rest = (keys[order], values[order])

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, -1 where there is none."""
        ok = (left >= 0) & (right >= 0)
        key = np.where(ok, left.astype(np.int64) << 20 | right.astype(np.int64), 2**62).astype(np.uint64)
        out = np.full(len(key), -1, np.int32)
        for factor, slot, value in self.tables:
            at = key * factor >> np.uint64(64 - 20)
            hit = slot[at] == key
            out[hit] = value[at[hit]]
        if len(self.rest[0]):
            at = np.minimum(np.searchsorted(self.rest[0], key), len(self.rest[0]) - 1)
            hit = self.rest[0][at] == key
            out[hit] = self.rest[1][at[hit]]
        return out

    def _skipped(self, key: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return mix64(key ^ (place.astype(np.uint64) << np.uint64(20) | piece.astype(np.uint64))) < self.limit

    def key(self, word: str, variant: int) -> int:
        """A key for a word outside of a text."""
        return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), self.seed * 1009 + variant)

    def keys(self, doc, n: int) -> np.ndarray:
        """The keys of the ``n`` words of a document."""
        own = xxhash.xxh64_intdigest("" if doc is None else str(doc), self.seed)
        return mix64(np.arange(n, dtype=np.uint64) + np.uint64(own))

    def _symbols(self, word: str) -> list[int]:
        """Ids of the characters; -1 for those that become bytes."""
        get = self.ids.get
        return [get(c, -1) for c in word]

    def _ids(self, word: str, symbols, ends) -> bytes:
        """Final symbols as packed ids; ``ends`` tells where each symbol stops in the word."""
        out, start = [], 0
        for s, end in zip(symbols, ends):
            if s >= 0:
                out.append(s)
            else:
                text = word[start:end].replace(LITERAL, MARK)
                out += [self.bytes[b] for b in text.encode()]
            start = end
        return np.array(out, np.int32).tobytes()

    def by_heap(self, word: str, key: int) -> bytes:
        """One word through its agenda."""
        symbols = self._symbols(word)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []
        seed, limit = np.array([key], np.uint64), self.rate > 0

        def add(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n and symbols[i] >= 0 and symbols[j] >= 0:
                piece = self.merges.get(symbols[i] << 20 | symbols[j])
                if piece is not None:
                    heapq.heappush(agenda, (int(self.rank[piece]), i, j, piece, symbols[i] << 20 | symbols[j]))

        for i in range(n - 1):
            add(i)
        gone = [False] * n
        while agenda:
            _, i, j, piece, pair = heapq.heappop(agenda)
            if gone[i] or gone[j] or after[i] != j or symbols[i] << 20 | symbols[j] != pair:
                continue
            if limit and self._skipped(seed, np.array([i]), np.array([piece]))[0]:
                continue
            symbols[i], gone[j] = piece, True
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            add(before[i])
            add(i)
        left = [i for i in range(n) if not gone[i]]
        return self._ids(word, [symbols[i] for i in left], [after[i] for i in left])

    def together(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        """Words of similar, small length through their agendas in step."""
        n, width = len(words), max(map(len, words))
        symbols = np.full((n, width + 1), -1, np.int32)
        length = np.fromiter(map(len, words), np.int64, n)
        start = np.arange(width + 1)
        alive = start[None, :] < length[:, None]
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols[alive] = self.by_code[codes]
        after = np.tile(np.arange(1, width + 2), (n, 1)).astype(np.int16)
        before = np.tile(np.arange(-1, width), (n, 1)).astype(np.int16)
        best = np.full((n, width), _NONE, np.int32)
        merged = np.full((n, width), -1, np.int32)

        def look(rows: np.ndarray, at: np.ndarray) -> None:
            """The candidate that starts at each place."""
            right = after[rows, at]
            ok = right < length[rows]
            piece = self._merged(symbols[rows, at], np.where(ok, symbols[rows, np.minimum(right, width)], -1))
            can = piece >= 0
            if self.rate > 0:
                some = np.flatnonzero(can)
                can[some] &= ~self._skipped(keys[rows[some]], at[some], piece[some])
            merged[rows, at] = piece
            best[rows, at] = np.where(can, self.rank[piece], _NONE)

        rows, at = np.nonzero(alive[:, :width] & (start[None, :width] + 1 < length[:, None]))
        look(rows, at)
        rows = np.arange(n)
        while len(rows):
            at = np.argmin(best[rows], axis=1)
            go = best[rows, at] < _NONE
            rows, at = rows[go], at[go]
            if not len(rows):
                break
            right = after[rows, at].astype(np.int64)
            beyond = after[rows, right]
            symbols[rows, at] = merged[rows, at]
            after[rows, at] = beyond
            alive[rows, right] = False
            inside = beyond < length[rows]
            before[rows[inside], beyond[inside]] = at[inside]
            closed = right < width
            best[rows[closed], right[closed]] = _NONE
            left = before[rows, at].astype(np.int64)
            has = left >= 0
            look(np.concatenate([rows, rows[has]]), np.concatenate([at, left[has]]))
        out = []
        flat_rows, flat_at = np.nonzero(alive)
        final, ends = symbols[flat_rows, flat_at], after[flat_rows, flat_at]
        cuts = np.searchsorted(flat_rows, np.arange(n + 1))
        whole = np.logical_and.reduceat(final >= 0, cuts[:-1])
        packed = final.tobytes()
        bounds = cuts.tolist()
        for word, a, b, plain in zip(words, bounds, bounds[1:], whole.tolist()):
            out.append(packed[4 * a : 4 * b] if plain else self._ids(word, final[a:b].tolist(), ends[a:b].tolist()))
        return out

    def encode_words(self, words: list[str], variant: int) -> list[bytes]:
        return self.encode_keyed(words, np.array([self.key(w, variant) for w in words], np.uint64))

    def encode_keyed(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        out = np.full(len(words), b"", object)
        size = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(size > SHORT).tolist():
            out[i] = self.by_heap(words[i], int(keys[i]))
        steps = -(-size // 4)
        for step in range(1, -(-SHORT // 4) + 1):
            rows = np.flatnonzero((steps == step) & (size <= SHORT))
            for a in range(0, len(rows), 20_000):
                part = rows[a : a + 20_000]
                out[part] = self.together([words[i] for i in part.tolist()], keys[part])
        return out.tolist()

    def cut(self, text: str) -> list[str]:
        """The words of a text, space marks and line feeds included; no piece crosses their ends."""
        if MARK in text:
            text = text.replace(MARK, LITERAL)
        if "  " in text or text[:1] == " ":
            words = _CUT.findall(MARK + text.replace(" ", MARK))
        else:
            words = (MARK + text.replace(" ", " " + MARK).replace("\n", " \n ")).split(" ")
        if len(text) > SHORT * len(words) or max(map(len, words)) > SHORT:
            words = [part for w in words for part in (self._cut_long(w) if len(w) > SHORT else (w,))]
        return words

    def _cut_long(self, word: str) -> list[str]:
        parts, start = [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.near:
                parts.append(word[start:i])
                start = i
        return [*parts, word[start:]]

    def _possible(self, word: str) -> list[int]:
        """place << 20 | piece of every merge that some draws let the word's agenda offer."""
        get, n, out = self.made.get, len(word), []
        for i in range(n - 1):
            for j in range(i + 2, min(n, i + self.longest) + 1):
                piece = get(word[i:j])
                if piece is not None:
                    out.append(i << 20 | piece)
        return out

    def _kinds(self, words: list[str], number: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """A number for each occurrence (of word ``number``, with its key); equal ones have the same word and draws."""
        if self.rate <= 0:
            return number.astype(np.uint64)
        often = np.bincount(number, minlength=len(words))
        shared = np.fromiter((len(w) <= SHORT for w in words), bool, len(words)) & (np.arange(len(words)) < 1 << WORDS)
        lists: list[list[int]] = [[]] * len(words)
        for i in np.flatnonzero(shared & (often > 1)).tolist():
            found = self.cache.get(words[i])
            if found is None and often[i] >= OFTEN:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                found = self.cache[words[i]] = self._possible(words[i])
            if found is None:
                shared[i] = False
            else:
                lists[i] = found
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        start = np.cumsum(size) - size
        codes = np.fromiter(chain.from_iterable(lists), np.uint64, int(size.sum()))
        shared &= (often > 1) & (size <= DRAWS)
        kinds = np.arange(len(number), dtype=np.uint64) | np.uint64(1 << 63)
        drawn = np.flatnonzero(shared[number])
        for a in range(0, len(drawn), 50_000):
            rows = drawn[a : a + 50_000]
            count = size[number[rows]]
            first = np.cumsum(count) - count
            bit = np.arange(int(count.sum())) - np.repeat(first, count)
            code = codes[np.repeat(start[number[rows]], count) + bit]
            gone = mix64(np.repeat(keys[rows], count) ^ code) < self.limit
            draws = np.zeros(len(rows), np.uint64)
            at = np.flatnonzero(gone)
            owner = np.repeat(np.arange(len(rows)), count)[at]
            np.bitwise_or.at(draws, owner, np.uint64(1) << bit[at].astype(np.uint64))
            kinds[rows] = number[rows].astype(np.uint64) << np.uint64(DRAWS) | draws
        return kinds

    def encode(self, texts: list[str | None], ids: list) -> list[np.ndarray | None]:
        """Piece ids of every text."""
        cuts = [self.cut(text) if text else [] for text in texts]
        ends = np.cumsum([len(x) for x in cuts]).tolist()
        flat = list(chain.from_iterable(cuts))
        numbers = {w: i for i, w in enumerate(dict.fromkeys(flat))}
        words, number = list(numbers), np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))
        keys = np.concatenate([self.keys(doc, len(x)) for x, doc in zip(cuts, ids)] or [np.empty(0, np.uint64)])
        _, first, kind = np.unique(self._kinds(words, number, keys), return_index=True, return_inverse=True)
        packed = self.encode_keyed([flat[i] for i in first.tolist()], keys[first])
        out, start = [], 0
        for text, end in zip(texts, ends):
            found = b"".join(map(packed.__getitem__, kind[start:end].tolist()))
            out.append(None if text is None else np.frombuffer(found, np.int32))
            start = end
        return out

    def decode(self, ids: np.ndarray | None) -> str | None:
        if ids is None:
            return None
        return b"".join(map(self.joined.__getitem__, ids.tolist())).decode()[1:]


def encode(docs: DataFrame, model: str = MODEL, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, pieces, n_pieces, pieces_sha256 (of the ids as little-endian 32-bit integers), lossless.

    ``lossless`` says that decoding the pieces gave the text back.
    """
    vocabulary = Vocabulary.load(model)

    def run(batches):
        codec = Codec(vocabulary, rate, seed)
        for part in slices(batches, rows=1000, limit=2 << 20):
            texts = part.column("text").to_pylist()
            found = codec.encode(texts, part.column("doc_id").to_pylist())
            same = [codec.decode(x) == t for x, t in zip(found, texts)]
            sizes = np.array([0 if x is None else len(x) for x in found])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate([x for x in found if x is not None] or [np.empty(0, np.int32)])
            null = np.array([x is None for x in found])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array(null)),
                    pa.array(sizes.astype(np.int64)), pa.array([hashlib.sha256(b"" if x is None else x.tobytes()).hexdigest() for x in found]),
                    pa.array(same),
                ],
                ["doc_id", "pieces", "n_pieces", "pieces_sha256", "lossless"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, pieces array<int>, n_pieces long, pieces_sha256 string, lossless boolean"
    )


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the text of its ``pieces``."""
    vocabulary = Vocabulary.load(model)

    def run(batches):
        codec = Codec(vocabulary, 0.0)
        for batch in batches:
            texts = [codec.decode(x.values.to_numpy() if x.is_valid else None) for x in batch.column("pieces")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "pieces").mapInArrow(run, "doc_id long, text string")
