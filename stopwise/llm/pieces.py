"""SentencePiece encoding and decoding with a byte-fallback BPE vocabulary.

The ids are those of the SentencePiece library for the same model file. A segmentation is the one
that merging finds exactly if each piece encodes to itself and each two neighbours encode to
themselves; it is the only path of the piece lattice with that property. So encoding is a path
search in the max-plus algebra, with weight 0 for neighbours that agree and minus infinity for
others, and matrices of such weights combine associatively.

Ordinary texts are encoded in one go, word by word: no piece holds a space after another
character, so words never merge, and each distinct word is segmented once per task. A giant text
is cut every ``CHUNK`` characters, wherever that falls:

1. Each chunk yields the transfer matrix from the pieces that may lie across its left edge to
   those that may lie across its right edge.
2. The matrices of a text are combined from both ends; the one piece per edge that both the start
   and the end can be reached from lies on the path. Only matrices meet here, a few dozen bytes
   per chunk, never texts.
3. Each chunk is backtraced between its two edge pieces, independently of the others.

Vocabularies are read, never trained; the path of the model file is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.text import small_batches_for, unique_name, written

CHUNK = 8_192
GIANT = 32_768
# What a worker keeps: bytes of words with their ids, and pairs of pieces.
CACHED_BYTES = 24 << 20
CACHED_PAIRS = 100_000
STRETCH = 512 << 10
# Texts and their ids are several times their size in a worker: batches stay below that of others.
ARROW_BYTES = "2m"
CACHED_CHARS = 48
# A word's share of its dictionary, and the headers of two objects.
WORD_BYTES = 220
# Fixed value: the character that stands for a space in pieces.
SPACE = "▁"
# Stands for that character where a text itself holds it; no valid text holds a lone surrogate.
LITERAL = "\udfff"
NEVER = -np.inf


@dataclass(frozen=True)
class Vocabulary:
    """Piece texts, scores and kinds by id, and the content of the model file."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[str, ...]
    model: bytes

    @staticmethod
    def load(path: str) -> "Vocabulary":
        import sentencepiece

        content = Path(path).read_bytes()
        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        ids = range(model.get_piece_size())

        def kind(i: int) -> str:
            if model.is_byte(i):
                return "byte"
            return "none" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "text"

        loaded = Vocabulary(
            tuple(model.id_to_piece(i) for i in ids),
            tuple(model.get_score(i) for i in ids),
            tuple(kind(i) for i in ids),
            content,
        )
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p, k in zip(loaded.pieces, loaded.kinds) if k == "text"):
            raise ValueError("a piece of this vocabulary reaches into the next word")
        if loaded.kinds.count("byte") != 256:
            raise ValueError("this vocabulary has no piece for each byte")
        return loaded


def _pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Decoder:
    """Decoding of one Python worker: the bytes of each id, and nothing else."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if kind == "byte"
            else piece.replace(SPACE, " ").encode() if kind == "text"
            else b""
            for piece, kind in zip(vocabulary.pieces, vocabulary.kinds)
        ]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a text; ids that stand for no text, and those out of range, add nothing."""
        ids, table = np.asarray(ids, np.int32), self.bytes_of
        if len(ids) and (ids.min() < 0 or ids.max() >= len(table)):
            ids = ids[(ids >= 0) & (ids < len(table))]
        joined = b"".join(map(table.__getitem__, ids.tolist()))
        return joined[1:] if joined[:1] == b" " else joined


class WordCache(dict):
    """Packed ids by word; ``make_room`` empties it before it comes to much over ``CACHED_BYTES``."""

    bytes = 0

    def make_room(self, words: Collection[str]) -> bool:
        """Before ``words`` are added; False if all others had to go."""
        more = sum(WORD_BYTES + 4 * len(word) for word in words)
        full = self.bytes + more > CACHED_BYTES
        if full:
            self.clear()
        self.bytes = more if full else self.bytes + more
        return not full


class Coder:
    """Encoding of one Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        text = [i for i, kind in enumerate(vocabulary.kinds) if kind == "text"]
        self.ids = {vocabulary.pieces[i]: i for i in text}
        self.scores = {vocabulary.pieces[i]: vocabulary.scores[i] for i in text}
        self.longest = max(map(len, self.ids), default=1)
        self.newline_free = not any("\n" in piece for piece in self.ids)
        self.byte_ids = [0] * 256
        for i, (piece, kind) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)):
            if kind == "byte":
                self.byte_ids[int(piece[3:5], 16)] = i
        # Packed ids of words that follow a space, without it, and of other pieces of text.
        self.words, self.others = WordCache(), WordCache()
        self.model, self.library = vocabulary.model, None
        self.agreeing: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}

    # ------------------------------------------------------------------ one word

    def segments(self, word: str) -> list[str]:
        """The pieces that merging the best-scored neighbours first, leftmost on ties, ends at."""
        if len(word) > 24:
            return self._segments_of_long(word)
        parts, score = list(word), self.scores.get
        pairs = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == NEVER:
                break
            at = pairs.index(best)
            merged = parts[at] + parts[at + 1]
            parts[at : at + 2] = [merged]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + merged, NEVER)
            if at < len(pairs):
                pairs[at] = score(merged + parts[at + 1], NEVER)
        return parts

    def _segments_of_long(self, word: str) -> list[str]:
        n, scores = len(word), self.scores
        parts = list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                merged = parts[i] + parts[j]
                if merged in scores:
                    heapq.heappush(heap, (-scores[merged], i, merged))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, merged = heapq.heappop(heap)
            j = after[i] if parts[i] else n
            if j >= n or parts[i] + parts[j] != merged:
                continue
            parts[i], parts[j] = merged, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [part for part in parts if part]

    def ids_of(self, parts: list[str]) -> list[int]:
        out = []
        for part in parts:
            if part in self.ids:
                out.append(self.ids[part])
            else:
                raw = SPACE if part == LITERAL else part
                out.extend(self.byte_ids[b] for b in raw.encode("utf-8", "surrogatepass"))
        return out

    def packed(self, word: str) -> bytes:
        found = self.others.get(word)
        if found is None:
            found = _pack(self.ids_of(self.segments(word)))
            if len(word) <= CACHED_CHARS:
                self.others.make_room([word])
                self.others[word] = found
        return found

    def learn(self, texts: list[str]) -> None:
        """Segment the words of some escaped texts that are new, all at once: those that follow
        a space, which the library segments the same way in far less time."""
        seen: set[str] = set()
        for text in texts:
            for line in text.split("\n") if self.newline_free else [text]:
                seen.update(line.split(SPACE)[1:])
        seen.discard("")
        fitting = {word for word in seen if len(word) <= CACHED_CHARS and LITERAL not in word}
        new = list(fitting.difference(self.words))
        if not self.words.make_room(new):
            new = list(fitting)
            self.words.bytes = sum(WORD_BYTES + 4 * len(word) for word in new)
        if self.library is None:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        for word, ids in zip(new, self.library.encode(new, num_threads=1)):
            self.words[word] = _pack(ids)

    # ------------------------------------------------------------------ whole texts

    def packed_ids(self, escaped: str) -> bytes:
        """The ids of a text whose spaces are escaped, cut where no piece can reach across, as
        32-bit numbers."""
        out: list[bytes] = []
        newline, known = self.packed("\n"), self.words.__getitem__
        for n, line in enumerate(escaped.split("\n") if self.newline_free else [escaped]):
            if n:
                out.append(newline)
            head, *words = line.split(SPACE)
            if head:
                out.append(self.packed(head))
            try:
                out.append(b"".join(map(known, words)))
            except KeyError:  # words that were not learnt, or spaces in a row
                for word in re.findall(f"{SPACE}+[^{SPACE}]*", line[len(head) :]):
                    out.append(self.words.get(word[1:]) or self.packed(word))
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed_ids(escaped(text)), np.int32).tolist() if text else []

    # ------------------------------------------------------------------ edges of chunks

    def _itself(self, piece: str) -> bool:
        if piece not in self.whole:
            self.whole[piece] = self.segments(piece) == [piece]
        return self.whole[piece]

    def agree(self, left: str, right: str) -> bool:
        pair = (left, right)
        if pair not in self.agreeing:
            if len(self.agreeing) >= CACHED_PAIRS:
                self.agreeing.clear()
            self.agreeing[pair] = self.segments(left + right) == [left, right]
        return self.agreeing[pair]

    def starting(self, text: str, at: int) -> Iterator[int]:
        """Ends of the pieces of the lattice that start at a character."""
        yield at + 1
        for end in range(at + 2, min(at + self.longest, len(text)) + 1):
            piece = text[at:end]
            if piece in self.ids and self._itself(piece):
                yield end

    def across(self, text: str, edge: int) -> list[tuple[int, int]]:
        """The pieces that hold the last character before an edge, as (start, end)."""
        return sorted(
            (start, end)
            for start in range(max(0, edge - self.longest), edge)
            for end in self.starting(text, start)
            if end >= edge
        )

    def settled(self, text: str, at: int) -> bool:
        """Whether no piece can reach across a place: before a space that follows none, or
        beside a newline."""
        here, there = text[at - 1], text[at]
        return (there == SPACE and here != SPACE) or (
            self.newline_free and (here == "\n" or there == "\n")
        )

    def transfer(self, text: str, left: int, right: int) -> np.ndarray:
        """Weights from the pieces across ``left`` to those across ``right``; 0 at the ends of
        a text means its one beginning or end."""
        entries = self.across(text, left) if left else [(0, 0)]
        exits = self.across(text, right)
        places = [p for p in range(left + self.longest, right - self.longest) if self.settled(text, p)]
        if places:
            head = self._reach(text, left, entries, places[0], None)
            tail = self._reach(text, places[-1], [(places[-1], places[-1])], right, exits)
            return head.max(axis=1, keepdims=True) + tail
        return self._reach(text, left, entries, right, exits)

    def _reach(self, text, left, entries, right, exits) -> np.ndarray:
        """Weights from entries to exits; without exits, to whatever ends at ``right``."""
        ending: dict[int, list[tuple[str, int]]] = {}
        for k, (start, end) in enumerate(entries):
            ending.setdefault(end, []).append((text[start:end], 1 << k))
        reached: dict[tuple[int, int], int] = {}
        for at in range(left, right):
            arrived = ending.pop(at, None)
            if not arrived:
                continue
            for end in self.starting(text, at):
                if exits is None and end > right:
                    continue
                piece, mask = text[at:end], 0
                for before, sources in arrived:
                    if mask | sources != mask and (not before or self.agree(before, piece)):
                        mask |= sources
                if mask:
                    if end < right:
                        ending.setdefault(end, []).append((piece, mask))
                    else:
                        reached[at, end] = mask
        if exits is None:
            # An entry may itself end at the place.
            for k, (start, end) in enumerate(entries):
                if end == right:
                    reached[start, end] = reached.get((start, end), 0) | 1 << k
            exits = sorted(reached)
        weights = np.full((len(entries), max(1, len(exits))), NEVER)
        for column, state in enumerate(exits):
            mask = reached.get(state, 0)
            for k in range(len(entries)):
                if mask >> k & 1:
                    weights[k, column] = 0.0
        return weights


def escaped(text: str) -> str:
    """A text as the vocabulary sees it: with a space in front, and every space escaped."""
    return SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The max-plus product of two transfer matrices; it is associative."""
    return (left[:, :, None] + right[None, :, :]).max(axis=1)


def path_states(matrices: list[np.ndarray]) -> list[int]:
    """For each chunk the index of the piece across its right edge."""
    forward, vector = [], np.zeros((1, 1))
    for matrix in matrices:
        vector = combine(vector, matrix)
        forward.append(vector[0])
    states, back = [], np.zeros((matrices[-1].shape[1], 1))
    for matrix, reach in zip(reversed(matrices), reversed(forward)):
        on_path = np.flatnonzero(reach + back[:, 0] == 0)
        if len(on_path) != 1:
            raise ValueError(f"{len(on_path)} segmentations where there must be one")
        states.append(int(on_path[0]))
        back = combine(matrix, back)
    return states[::-1]


# ---------------------------------------------------------------------- on DataFrames


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    ids: str = "ids",
    chunk: int = CHUNK,
    giant: int = GIANT,
    round_trip: str | None = None,
) -> DataFrame:
    """``docs`` with a column of piece ids (``array<int>``); a column of that name is replaced.

    ``round_trip`` names a further column: whether the decoded ids are the text again, null
    counting as empty. Ids are decoded where they are made, so no task holds a second worker.

    Null and empty texts have no ids. U+2581 in a text, which the library would turn into a
    space, is kept through its bytes, so every text survives the round trip. Texts of more than
    ``giant`` characters go through chunks of ``chunk``.
    """
    small_batches_for(docs.sparkSession, ARROW_BYTES)
    kept = [c for c in docs.columns if c not in (ids, round_trip)]
    own = docs.select(*kept)
    key = unique_name(own, "_key")
    ordinary = own.where(F.coalesce(F.length(text), F.lit(0)) <= giant)
    giants = own.where(F.length(text) > giant).withColumn(key, F.sha2(F.col(text).cast("binary"), 256))
    found = giant_ids(giants.select(F.col(key).alias("key"), F.col(text).alias("text")), vocabulary, chunk)
    other = unique_name(giants, "_same_key")
    found = found.select(F.col("key").alias(other), F.col("ids").alias(ids))
    long = giants.join(found, F.col(key) == F.col(other), "left")
    if round_trip is None:
        short = ordinary.withColumn(ids, _encoded(vocabulary)(F.col(text)))
        return short.select(*kept, ids).unionByName(long.select(*kept, ids))
    both = unique_name(own, "_checked")
    short = ordinary.withColumn(both, _encoded_and_checked(vocabulary)(F.col(text))).select(
        *kept, F.col(f"{both}.ids").alias(ids), F.col(f"{both}.same").alias(round_trip)
    )
    same = decoded(F.col(ids), vocabulary) == F.col(text)
    return short.unionByName(long.select(*kept, ids, same.alias(round_trip)))


def _packed(coder: Coder, texts: pd.Series) -> Iterator[tuple[str | None, bytes]]:
    """Each text with its ids, a stretch of texts at a time."""
    for some in _stretches(texts):
        escaped_texts = [escaped(text) if text else "" for text in some]
        coder.learn(escaped_texts)
        for text, whole in zip(some, escaped_texts):
            yield text, coder.packed_ids(whole) if whole else b""


def _encoded(vocabulary: Vocabulary):
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = Coder(vocabulary)
        for batch in batches:
            ids = [np.frombuffer(packed, np.int32) for _, packed in _packed(coder, batch)]
            yield pd.Series(ids, dtype=object)

    return run


def _encoded_and_checked(vocabulary: Vocabulary):
    @F.pandas_udf("ids array<int>, same boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder, decoder = Coder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            ids, same = [], []
            for text, packed in _packed(coder, batch):
                ids.append(np.frombuffer(packed, np.int32))
                same.append(decoder.decode(ids[-1]) == (text or "").encode())
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "same": pd.Series(same, dtype=bool)})

    return run


def _stretches(texts: pd.Series) -> Iterator[list[str | None]]:
    """The same texts, about ``STRETCH`` characters at a time: what is made of them is many times
    their size."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text or "")
        if size >= STRETCH:
            yield some
            some, size = [], 0
    if some:
        yield some


def decoded(ids, vocabulary: Vocabulary):
    """The text of a column of ids, as a column; null for null. Bytes that are no UTF-8, which
    no encoded text gives, become U+FFFD."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            yield pd.Series(
                [None if x is None else decoder.decode(x).decode("utf-8", "replace") for x in batch],
                dtype=object,
            )

    return run(ids)


def giant_ids(texts: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK) -> DataFrame:
    """``key, text`` -> ``key, ids``, one row per key; the key is a digest of the text."""
    spark = texts.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = max(map(len, vocabulary.pieces))
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                whole = escaped(text)
                edges = list(range(0, len(whole), chunk)) + [len(whole)]
                if len(edges) > 2 and edges[-1] - edges[-2] < 4 * reach:
                    del edges[-2]
                rows = []
                for no, (left, right) in enumerate(zip(edges, edges[1:])):
                    begin = max(0, left - reach)
                    body = whole[begin : right + reach].encode("utf-8", "surrogatepass")
                    rows.append((key, no, left - begin, right - begin, body))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _CHUNK_TYPES)], _CHUNK_NAMES
                )

    chunks = (
        texts.mapInArrow(cut, "key string, no int, left int, right int, body binary")
        .groupBy("key", "no")
        .agg(F.first("left").alias("left"), F.first("right").alias("right"), F.first("body").alias("body"))
    )
    chunks = written(spark, chunks, "piece-chunks")

    def transfers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(vocabulary)
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                text = row.body.decode("utf-8", "surrogatepass")
                matrix = coder.transfer(text, row.left, row.right)
                exits = coder.across(text, row.right)
                rows.append(
                    (
                        row.key,
                        row.no,
                        (matrix == 0).astype(np.uint8).tobytes(),
                        matrix.shape[1],
                        [start - row.right for start, _ in exits],
                        [end - row.right for _, end in exits],
                    )
                )
            yield pd.DataFrame(rows, columns=["key", "no", "open", "width", "starts", "ends"])

    matrices = chunks.select("key", "no", "left", "right", "body").mapInPandas(
        transfers,
        "key string, no int, open binary, width int, starts array<int>, ends array<int>",
    )

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("no")
        weights = []
        for row in frame.itertuples():
            cells = np.frombuffer(row.open, np.uint8).reshape(-1, row.width)
            weights.append(np.where(cells, 0.0, NEVER))
        # At the end of a text only pieces that end there count.
        final = np.array([end == 0 for end in frame["ends"].iloc[-1]])
        weights[-1] = np.where(final[None, :], weights[-1], NEVER)
        states = path_states(weights)
        exits = [(s[k], e[k]) for s, e, k in zip(frame["starts"], frame["ends"], states)]
        entries = [0] + [end for _, end in exits[:-1]]
        return pd.DataFrame(
            {
                "key": frame["key"].to_numpy(),
                "no": frame["no"].to_numpy(),
                "enter": entries,
                "leave_start": [s for s, _ in exits],
                "leave_end": [e for _, e in exits],
            }
        )

    states = matrices.groupBy("key").applyInPandas(
        scan, "key string, no int, enter int, leave_start int, leave_end int"
    )

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            keys, numbers, out = [], [], []
            for key, no, left, right, body, enter, start, end in zip(
                *(batch.column(i).to_pylist() for i in range(8))
            ):
                text = body.decode("utf-8", "surrogatepass")
                coder.learn([text[left + enter : right + start]])
                found = coder.packed_ids(text[left + enter : right + start])
                found += _pack(coder.ids_of([text[right + start : right + end]]))
                keys.append(key)
                numbers.append(no)
                out.append(np.frombuffer(found, np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(numbers, pa.int32()), pa.array(out, pa.list_(pa.int32()))],
                ["key", "no", "ids"],
            )

    traced = (
        chunks.join(states, ["key", "no"])
        .select("key", "no", "left", "right", "body", "enter", "leave_start", "leave_end")
        .mapInArrow(trace, "key string, no int, ids array<int>")
    )
    return traced.groupBy("key").agg(
        F.flatten(
            F.transform(F.sort_array(F.collect_list(F.struct("no", "ids"))), lambda part: part["ids"])
        ).alias("ids")
    )


_CHUNK_NAMES = ["key", "no", "left", "right", "body"]
_CHUNK_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]


def round_trips(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, text, ids`` -> ``doc_id, n_pieces, ids_sha256, decoded_sha256, round_trip``.

    The digests are of the ids as 32-bit little-endian numbers and of the decoded bytes. A null
    text counts as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            doc_ids, texts, lists = batch.column(0), batch.column(1), batch.column(2)
            rows = []
            for text, ids in zip(texts, lists):
                numbers = ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int32)
                body = decoder.decode(numbers)
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                rows.append(
                    (
                        len(numbers),
                        hashlib.sha256(numbers.astype("<i4").tobytes()).hexdigest(),
                        hashlib.sha256(body).hexdigest(),
                        body == raw,
                    )
                )
            columns = list(zip(*rows)) or [()] * 4
            types = [pa.int64(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [doc_ids, *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_pieces", "ids_sha256", "decoded_sha256", "round_trip"],
            )

    return encoded.select(F.col("doc_id").cast("long"), "text", "ids").mapInArrow(
        run,
        "doc_id long, n_pieces long, ids_sha256 string, decoded_sha256 string, round_trip boolean",
    )
