"""N-best SentencePiece segmentation of whole texts, and decoding.

A text is a lattice of the pieces of a model file, each with the score of the file. Forward Viterbi gives the best score up
to every place; these scores are exact heuristics for an A* search that starts at the end and completes paths to the
start in the order of their whole scores. No piece of such a model reaches over the start of a word, so the lattice of a
text is a chain of word lattices: Viterbi runs over many new words at once and tells for every word its
best path and what its second best loses. Of a text's words only the ``n - 1`` that lose least can differ in its ``n``
best paths; A* runs on those, and their paths are combined. All ``n`` paths are given, each with its score and ids.

The n best paths are those of the scores in the file. For a unigram model they are its own segmentations. A BPE model's scores
are merge ranks, whose best sum is another path than its merges give: on 300 documents none had the ids of the public encoder,
321,876 ids against its 282,276. All of them decode to the text.

Encoding adds the leading blank of the model and writes characters without a piece as bytes; decoding gives the text back
exactly, also where it holds the character that stands for a blank in pieces.

Defined cases: a null or empty text has no pieces, the score 0 and one path. Ties take the path whose last differing
piece is longer. Very long words cost memory in proportion. Rows that repeat an id are encoded each by themselves.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

N_BEST = 4
CACHE_WORDS = 400_000
BATCH_TEXTS = 256
BLANK = "▁"  # stands for a blank in pieces (fixed)
_LITERAL = 0x110001  # stands for that character itself in texts
_HASH = np.uint64(0xBF58476D1CE4E5B9)
_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], dtype=np.uint64)
_RUNS = re.compile(" +[^ ]*")
NEVER = -1e18


class PieceLattice:
    """Pieces of a model with scores, found by hash at every place of many words at once."""

    _loaded: dict[str, PieceLattice] = {}

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: list[int], n_best: int = N_BEST):
        """``pieces``: text, id, score. ``byte_ids``: id of each of the 256 bytes."""
        self.n_best, self.byte_ids = n_best, byte_ids
        self.longest = max((len(p) for p, _, _ in pieces), default=1)
        self.least = min((s for _, _, s in pieces), default=0.0) - 10.0
        self.ids = np.array([i for _, i, _ in pieces] + [-1], dtype=np.int64)
        self.scores = np.array([s for _, _, s in pieces] + [NEVER])
        self.known = {p: (i, s) for p, i, s in pieces}
        # beginnings of pieces, and the piece that each of them is, if any
        number = {p: n for n, (p, _, _) in enumerate(pieces)}
        self.beginnings = {p[:k] for p in number for k in range(1, len(p) + 1)}
        listed = sorted(self.beginnings)
        self.piece = np.array([number.get(x, len(pieces)) for x in listed] + [len(pieces)], dtype=np.int32)
        self.hashes = np.array([self._hash(x) for x in listed] + [0], dtype=np.uint64)
        self._place_beginnings()
        bytes_of = {i: p.replace(BLANK, " ").encode() for p, i, _ in pieces} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.byte_size = np.zeros(max(bytes_of, default=0) + 1, dtype=np.int64)
        for i, text in bytes_of.items():
            self.byte_size[i] = len(text)
        self.byte_start = np.cumsum(self.byte_size) - self.byte_size
        self.bytes = np.frombuffer(b"".join(text for _, text in sorted(bytes_of.items())), dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        """Empties the tables of solved words: places and sizes of their ids, scores and losses."""
        self.row: dict[str, int] = {}
        self.paths: dict[str, list[tuple[float, bytes, bool]]] = {}
        self.store = np.zeros(1 << 16, dtype="<i4")
        self.used = 0
        self.start, self.size = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.score, self.loss = np.zeros(1 << 12), np.zeros(1 << 12)

    @classmethod
    def load(cls, path: str, n_best: int = N_BEST) -> PieceLattice:
        """From a SentencePiece model file, one per worker process."""
        if (path, n_best) not in cls._loaded:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
            pieces = [(model.id_to_piece(i), i, model.get_score(i)) for i in plain]
            if any(BLANK in p.lstrip(BLANK) for p, _, _ in pieces):
                raise ValueError("a piece reaches over the start of a word")
            cls._loaded[path, n_best] = cls(pieces, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], n_best)
        return cls._loaded[path, n_best]

    def _place_beginnings(self) -> None:
        """Two hash tables; the second holds those whose slot in the first is taken. They grow until all fit."""
        none = len(self.hashes) - 1
        for bits in range(20, 27, 2):
            self.shift = np.uint64(64 - bits)
            self.tables = [np.full(1 << bits, none, dtype=np.int32) for _ in range(2)]
            self.crowded = np.zeros(1 << bits, dtype=bool)
            slots = self._slot(self.hashes[:-1], 0)
            _, first = np.unique(slots, return_index=True)
            self.tables[0][slots[first]] = first
            rest = np.setdiff1d(np.arange(none), first)
            self.crowded[slots[rest]] = True
            spare = self._slot(self.hashes[rest], 1)
            if len(np.unique(spare)) == len(spare):
                self.tables[1][spare] = rest
                return
        raise ValueError("the pieces do not fit the tables")

    def _slot(self, h: np.ndarray, table: int) -> np.ndarray:
        return ((h * _MULTIPLY[table]) >> self.shift).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Number of the beginning with each hash, or that of none."""
        none = len(self.hashes) - 1
        slot = self._slot(h, 0)
        at = self.tables[0][slot]
        at[self.hashes[at] != h] = none
        again = np.flatnonzero(self.crowded[slot] & (at == none))
        if len(again):
            other = self.tables[1][self._slot(h[again], 1)]
            at[again] = np.where(self.hashes[other] == h[again], other, none)
        return at

    @staticmethod
    def _hash(piece: str) -> int:
        h = 1
        for c in piece:
            h = (h * int(_HASH) + ord(c) + 1) % (1 << 64)
        return h

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        """Code points of words, each with the blank before it, as pieces write them."""
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        c[c == ord(BLANK)] = _LITERAL
        c[c == 32] = ord(BLANK)
        return c

    def _edges(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For words of one length (a column each): for each piece length, the piece at every place and its score.

        A place goes on to the next length only while its characters are the beginning of some piece.
        """
        n, w = codes.shape
        none, flat = len(self.ids) - 1, codes.reshape(-1)
        at, h = np.arange(n * w), np.ones(n * w, dtype=np.uint64)
        out = []
        for k in range(1, min(self.longest, n) + 1):
            inside = np.searchsorted(at, (n - k + 1) * w)
            at, h = at[:inside], h[:inside]
            h = h * _HASH + flat[at + (k - 1) * w] + np.uint64(1)
            begun = self._find(h)
            piece = np.full((n - k + 1) * w, none, dtype=np.int32)
            piece[at] = self.piece[begun]
            weight = self.scores[piece]
            if k == 1:
                weight[piece == none] = self.least
            out.append((piece.reshape(-1, w), weight.reshape(-1, w)))
            live = begun < len(self.hashes) - 1
            at, h = at[live], h[live]
            if not len(at):
                break
        return out

    def _solve(self, words: list[str]) -> None:
        """Adds the best path of words of one length, its score, and what the second best path loses (inf if there is none)."""
        w, n = len(words), len(words[0]) + 1
        codes = np.ascontiguousarray(self._codes(" " + " ".join(words)).reshape(w, n).T)
        edges = self._edges(codes)
        some = [(piece < len(self.ids) - 1).any(axis=1) if k else np.ones(n, dtype=bool) for k, (piece, _) in enumerate(edges)]
        first, second, last = np.full((n + 1, w), NEVER), np.full((n + 1, w), NEVER), np.zeros((n + 1, w), dtype=np.int16)
        first[0] = 0.0
        for t in range(1, n + 1):
            best, next_best, step = first[t], second[t], last[t]
            for k in range(1, min(len(edges), t) + 1):
                if some[k - 1][t - k]:
                    weight = edges[k - 1][1][t - k]
                    a, b = first[t - k] + weight, second[t - k] + weight
                    np.maximum(next_best, b, out=next_best)
                    np.maximum(next_best, np.minimum(best, a), out=next_best)
                    step[a >= best] = k
                    np.maximum(best, a, out=best)
        # back along the best paths of all words together
        word, t, steps = np.arange(w), np.full(w, n), []
        while len(word):
            k = last[t, word].astype(np.int64)
            t = t - k
            steps.append((word, t, k))
            word, t = word[t > 0], t[t > 0]
        word, t, k = (np.concatenate(x) for x in zip(*steps))
        forward = np.lexsort((t, word))
        word, t, k = word[forward], t[forward], k[forward]
        tokens = np.empty(len(word), dtype=np.int64)
        for length in np.unique(k).tolist():
            mine = k == length
            tokens[mine] = self.ids[edges[length - 1][0][t[mine], word[mine]]]
        if tokens.min(initial=0) < 0:  # characters that are written as bytes
            each = [self._tokens(x, int(codes[t[j], word[j]])) if x < 0 else [x] for j, x in enumerate(tokens.tolist())]
            word = np.repeat(word, [len(x) for x in each])
            tokens = np.array([i for x in each for i in x], dtype=np.int64)
        sizes = np.bincount(word, minlength=w)
        low = len(self.row)
        self._room(low + w, self.used + len(tokens))
        self.store[self.used : self.used + len(tokens)] = tokens
        self.start[low : low + w], self.size[low : low + w] = self.used + np.cumsum(sizes) - sizes, sizes
        self.score[low : low + w] = first[n]
        self.loss[low : low + w] = np.where(second[n] > NEVER / 2, first[n] - second[n], np.inf)
        self.used += len(tokens)
        self.row.update(zip(words, range(low, low + w)))

    def _room(self, rows: int, tokens: int) -> None:
        if tokens > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(max(tokens, len(self.store)), dtype="<i4")])
        if rows > len(self.start):
            for name in ("start", "size", "score", "loss"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros(max(rows, len(old)), dtype=old.dtype)]))

    def _tokens(self, piece: int, code: int) -> list[int]:
        """The id of a piece, or the ids of the bytes of a character without one."""
        if piece >= 0:
            return [piece]
        return [self.byte_ids[b] for b in (BLANK if code == _LITERAL else chr(code)).encode("utf-8", "surrogatepass")]

    def best_paths(self, word: str, n: int | None = None) -> list[tuple[float, tuple[int, ...]]]:
        """The n best paths of a word, best first: A* from its end, led by the forward scores."""
        codes = self._codes(" " + word).tolist()
        text = "".join("\0" if c == _LITERAL else chr(c) for c in codes)
        size = len(codes)
        ahead = [0.0] + [NEVER] * size
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(size + 1)]
        for start in range(size):
            for k in range(1, min(self.longest, size - start) + 1):
                part = text[start : start + k]
                piece, score = self.known.get(part, (-1, self.least if k == 1 else NEVER))
                if score > NEVER / 2:
                    into[start + k].append((k, piece, score))
                if part not in self.beginnings:
                    break
        for edges in into:
            edges.sort()
        for t in range(1, size + 1):
            for k, piece, score in into[t]:
                ahead[t] = max(ahead[t], ahead[t - k] + score)
        # among equal whole scores the path that has come farthest goes on, so ties do not fan out
        count = itertools.count()
        heap = [(-round(ahead[size], 6), size, next(count), 0.0, None)]
        done: list[tuple[float, tuple[int, ...]]] = []
        while heap and len(done) < (n or self.n_best):
            _, t, _, score, path = heapq.heappop(heap)
            if t == 0:
                tokens: list[int] = []
                while path:
                    place, piece, path = path
                    tokens += self._tokens(piece, codes[place])
                done.append((score, tuple(tokens)))
                continue
            for k, piece, value in reversed(into[t]):
                heapq.heappush(heap, (-round(score + value + ahead[t - k], 6), t - k, next(count), score + value, (t - k, piece, path)))
        return done

    def _word_paths(self, word: str) -> list[tuple[float, bytes, bool]]:
        """For the n best paths of a word: what each loses, its ids, and whether they give the word back."""
        found = self.paths.get(word)
        if found is None:
            listed = self.best_paths(word)
            found = [(listed[0][0] - score, struct.pack(f"<{len(ids)}i", *ids)) for score, ids in listed]
            self.paths[word] = found = [(loss, ids, self._plain(np.frombuffer(ids, "<i4")) == (" " + word).encode("utf-8", "surrogatepass")) for loss, ids in found]
        return found

    def _rows(self, split: list[list[str]]) -> np.ndarray:
        """Rows of the solved words of some texts; new words are solved by length."""
        if len(self.row) > CACHE_WORDS:
            self._forget()
        flat = [w for words in split for w in words]
        rows = list(map(self.row.get, flat))
        if None in rows:
            by_size: dict[int, list[str]] = {}
            for word in {w for w, r in zip(flat, rows) if r is None}:
                by_size.setdefault(len(word), []).append(word)
            for size, words in by_size.items():
                room = max(1, (1 << 18) // (size + 1))
                for low in range(0, len(words), room):
                    self._solve(words[low : low + room])
            rows = list(map(self.row.__getitem__, flat))
        return np.array(rows, dtype=np.int64)

    def _segments(self, texts: list[str]) -> Iterator[tuple[bytes, list[float], list[bytes], list[bool]]]:
        split = []
        for text in texts:
            uneven = "  " in text or text[:1] == " " or text[-1:] == " "
            split.append([] if not text else [c[1:] for c in _RUNS.findall(" " + text)] if uneven else text.split(" "))
        rows = self._rows(split)
        sizes, losses, scores = self.size[rows], self.loss[rows], self.score[rows]
        ends = np.cumsum(sizes)
        ids = self.store[np.repeat(self.start[rows] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        low = 0
        for text, words in zip(texts, split):
            if not words:
                yield b"", [0.0], [b""], [True]
                continue
            high = low + len(words)
            begin = int(ends[low] - sizes[low])
            mine, loss = ids[begin : int(ends[high - 1])], losses[low:high]
            best, whole = float(scores[low:high].sum()), mine.tobytes()
            some = min(self.n_best - 1, len(words))
            order = np.argsort(loss, kind="stable") if len(words) < 64 else np.argpartition(loss, some)
            ways: list[tuple[float, tuple, bool]] = [(0.0, (), True)]
            for i in sorted(order[:some].tolist()):
                if loss[i] < np.inf:
                    place = (4 * (int(ends[low + i] - sizes[low + i]) - begin), 4 * (int(ends[low + i]) - begin))
                    choices = self._word_paths(words[i])
                    # of two sorted lists, pair (a, b) can be among the n best only if (a + 1) (b + 1) <= n
                    pairs = [(x[0] + y[0], (*x[1], (*place, y[1])), x[2] and y[2]) for a, x in enumerate(ways) for y in choices[: self.n_best // (a + 1)]]
                    ways = sorted(pairs, key=lambda way: way[0])[: self.n_best]
            paths = [self._changed(whole, way) for _, way, _ in ways]
            same = self._plain(np.frombuffer(paths[0], "<i4"))[1:] == text.encode("utf-8", "surrogatepass")
            yield paths[0], [best - x for x, _, _ in ways], paths, [same and way[2] for way in ways]
            low = high

    def encode_checked(self, texts: list[str]) -> Iterator[tuple[bytes, list[float], list[bytes], list[bool]]]:
        """``encode``, and for each path whether it gives the text back.

        The best path is decoded whole; the others equal it but for words whose ids are decoded by themselves.
        """
        for low in range(0, len(texts), BATCH_TEXTS):
            yield from self._segments(texts[low : low + BATCH_TEXTS])

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, list[float], list[bytes]]]:
        """For each text: ids of the best path (little-endian 32-bit), scores of the n best, and the ids of each of those."""
        for ids, scores, paths, _ in self.encode_checked(texts):
            yield ids, scores, paths

    @staticmethod
    def _changed(ids: bytes, way: tuple[tuple[int, int, bytes], ...]) -> bytes:
        """Ids of a text with other ids in some places (first and last byte, ids)."""
        out, done = [], 0
        for start, end, other in way:
            out += [ids[done:start], other]
            done = end
        return b"".join([*out, ids[done:]])

    def _plain(self, ids: np.ndarray) -> bytes:
        """Bytes of ids, with the leading blank."""
        sizes = self.byte_size[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return self.bytes[np.repeat(self.byte_start[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]))].tobytes()

    def decode(self, ids: bytes) -> str:
        return self._plain(np.frombuffer(ids, "<i4"))[1:].decode("utf-8", "surrogatepass")


def encode_documents(docs: DataFrame, model: str, n_best: int = N_BEST, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, n_ids, ids_crc32, scores (of the n best paths, best first), decoded_sha256, paths, and the ids if asked for.

    ``paths``, best first: score, n_ids, ids_crc32, same_text (its ids give the text back), and its ids if asked for.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = PieceLattice.load(model, n_best)
        for batch in (whole.slice(i, BATCH_TEXTS) for whole in batches for i in range(0, whole.num_rows, BATCH_TEXTS)):
            texts, rows = batch.column(1).to_pylist(), []
            for text, (ids, scores, paths, same) in zip(texts, lattice.encode_checked(texts)):
                digest = hashlib.sha256(text.encode("utf-8", "surrogatepass") if same[0] else lattice.decode(ids).encode("utf-8", "surrogatepass")).hexdigest()
                sums = [zlib.crc32(p) for p in paths]
                row = (len(ids) // 4, sums[0], scores, digest, [len(p) // 4 for p in paths], sums, same)
                rows.append((*row, paths, ids) if with_ids else row)
            made = [pa.array(list(c), type=t) for c, t in zip(zip(*rows), arrow[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=names)

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    fields = [narrow.schema["doc_id"], T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("decoded_sha256", T.StringType())]
    fields += [T.StructField("path_n_ids", T.ArrayType(T.LongType())), T.StructField("path_crc32", T.ArrayType(T.LongType())), T.StructField("path_same", T.ArrayType(T.BooleanType()))]
    fields += [T.StructField("path_ids", T.ArrayType(T.BinaryType())), T.StructField("ids", T.BinaryType())] if with_ids else []
    names, arrow = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]
    parts = {"scores": "score", "path_n_ids": "n_ids", "path_crc32": "ids_crc32", "path_same": "same_text"} | ({"path_ids": "ids"} if with_ids else {})
    paths = F.arrays_zip(*[F.col(c).alias(name) for c, name in parts.items()])
    coded = narrow.mapInArrow(run, T.StructType(fields)).withColumn("paths", paths)
    return coded.select("doc_id", "n_ids", "ids_crc32", "scores", "decoded_sha256", "paths", *["ids"] * with_ids)
