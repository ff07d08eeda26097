"""Remove passages of ``WINDOW`` words or more that an earlier document has.

A window is a run of ``WINDOW`` words of one document. Its words go if the same words also stand
in a document with a smaller doc_id. Windows are judged on the input, not on what is left.

1. Documents are cut into segments such that equal windows fall into segments of one shard: each
   window is named by the least hash of the three-word grams it holds, and neighbours of one name
   form a segment. A segment that a batch of documents has several times is sent once, for the
   smallest doc_id that has it, and the others are marked removed there and then; so a passage
   that a third of all documents share reaches its shard once per batch.
2. Each shard builds a compressed FM-index over those of its segments whose name occurs in two
   documents, and streams the same segments past it: backward search over the wavelet matrix
   finds all places of each window, and the smallest doc_id among them says whether it goes.
   Shards hold about the same number of documents' worth of segments however large the corpus is.
3. The removed stretches of each document are united and its text is joined with them.

Word sequences are compared by 64-bit hashes of words where segments are named, merged and sent,
and by word numbers in the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.fm_index import DEPTH, FMIndex
from stopwise.llm.hashing import GOLDEN, chained, mixed, small_batches, words_of_texts
from stopwise.llm.text import release_shuffles, small_batches_for, written

WINDOW = 13
GRAM = 3
CUT_BYTES = 8 << 20
DOCS_A_SHARD = 800
QUERIES_AT_ONCE = 200_000


def _least_in(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` neighbours."""
    out, have = values, 1
    while have < span:
        step = min(have, span - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Segments:
    """The segments of a batch: name, text number, first word and number of words, and a digest
    of the words."""

    def __init__(self, words, window: int):
        grams = chained(words.hashes, GRAM)
        empty = np.zeros(0, np.int64)
        self.name, self.text, self.start, self.size, self.digest = np.zeros(0, np.uint64), empty, empty, empty, np.zeros(0, np.uint64)
        if len(words.hashes) < window:
            return
        names = _least_in(grams, window - GRAM + 1)
        text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        own = text[: len(names)]
        whole = own == text[window - 1 :]
        changes = np.empty(len(names), bool)
        changes[0] = True
        changes[1:] = (names[1:] != names[:-1]) | (own[1:] != own[:-1]) | (whole[1:] != whole[:-1])
        begin = np.flatnonzero(changes)
        count = np.diff(np.append(begin, len(names)))
        kept = whole[begin]
        begin, count = begin[kept], count[kept]
        self.name, self.text = names[begin], own[begin]
        self.start, self.size = begin, count + window - 1
        # Word hashes times place, summed by differences of running sums, tell segments apart.
        power = _powers(len(words.hashes))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes * power[0])])
        self.digest = mixed((sums[begin + self.size] - sums[begin]) * power[1][begin] + self.size.astype(np.uint64) * GOLDEN)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    base = np.uint64(0xD6E8FEB86659FD93)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def _flat(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin - total + size, size)


_COLUMNS = (("name", np.uint64), ("doc", np.int64), ("key", np.int64), ("start", np.int64), ("size", np.int64), ("bytes", np.int64))


def _pack(columns: dict[str, np.ndarray], body: bytes, level: int = 3) -> bytes:
    head = np.array([len(columns["name"])], np.int64).tobytes()
    return zstandard.compress(head + b"".join(columns[c].astype(k).tobytes() for c, k in _COLUMNS) + body, level)


def _unpack(blob: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    columns = {c: np.frombuffer(raw, k, n, 8 + 8 * n * i) for i, (c, k) in enumerate(_COLUMNS)}
    return columns, raw[8 + 8 * n * len(_COLUMNS) :]


def _cut(batches: Iterator[pa.RecordBatch], window: int, n_shards: int) -> Iterator[pa.RecordBatch]:
    """``doc_id, key, text`` -> ``shard, blob``; a blob holds segments with their texts, or,
    where a size in bytes is -1, stretches to remove."""
    for batch in small_batches(batches, 2, CUT_BYTES):
        words = words_of_texts(batch.column(2))
        doc, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        seg = Segments(words, window)
        if not len(seg.name):
            continue
        first = words.first[:-1][seg.text]
        owner = doc[seg.text]
        order = np.lexsort((owner, seg.digest, seg.name))
        same = np.zeros(len(order), bool)
        a, b = order[1:], order[:-1]
        same[1:] = (seg.name[a] == seg.name[b]) & (seg.digest[a] == seg.digest[b])
        lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        goes = np.zeros(len(order), bool)
        goes[order] = owner[lead] < owner[order]
        # Of one document's equal segments each is sent: their places differ.
        sent = np.flatnonzero(~goes)
        low = words.begin[seg.start[sent]]
        sizes = words.end[seg.start[sent] + seg.size[sent] - 1] - low
        gone = np.flatnonzero(goes)
        columns = {
            "name": np.concatenate([seg.name[sent], mixed(doc[seg.text[gone]].astype(np.uint64))]),
            "doc": np.concatenate([owner[sent], owner[gone]]),
            "key": np.concatenate([key[seg.text[sent]], key[seg.text[gone]]]),
            "start": np.concatenate([seg.start[sent] - first[sent], seg.start[gone] - first[gone]]),
            "size": np.concatenate([seg.size[sent], seg.size[gone]]),
            "bytes": np.concatenate([sizes, np.full(len(gone), -1, np.int64)]),
        }
        low = np.concatenate([low, np.zeros(len(gone), np.int64)])
        shard = (mixed(columns["name"]) % np.uint64(n_shards)).astype(np.int64)
        order = np.lexsort((columns["start"], columns["doc"], shard))
        edges = np.flatnonzero(np.diff(shard[order], prepend=-1))
        numbers, blobs = [], []
        for a, b in zip(edges, np.append(edges[1:], len(order))):
            rows = order[a:b]
            lengths = np.maximum(columns["bytes"][rows], 0)
            body = words.body[_flat(low[rows], lengths)].tobytes()
            numbers.append(int(shard[rows[0]]))
            blobs.append(_pack({c: v[rows] for c, v in columns.items()}, body))
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def _matched(blobs: list[bytes], window: int) -> dict[str, np.ndarray]:
    """The stretches to remove that one shard finds: ``doc, key, start, size``."""
    parts, bodies = zip(*map(_unpack, blobs))
    columns = {c: np.concatenate([p[c] for p in parts]) for c, _ in _COLUMNS}
    told = columns["bytes"] < 0
    found = [{c: columns[c][told] for c in ("doc", "key", "start", "size")}]
    body = np.frombuffer(b"".join(bodies), np.uint8)
    lengths = np.maximum(columns["bytes"], 0)
    low = np.cumsum(lengths) - lengths
    live = np.flatnonzero(~told)
    # Names that two documents have.
    order = live[np.argsort(columns["name"][live], kind="stable")]
    names, begin = np.unique(columns["name"][order], return_index=True)
    if len(names):
        docs = columns["doc"][order]
        several = np.minimum.reduceat(docs, begin) != np.maximum.reduceat(docs, begin)
        order = order[np.repeat(several, np.diff(np.append(begin, len(order))))]
    if not len(names) or not len(order):
        return found[0]
    segment_bytes = lengths[order]
    texts = pa.LargeStringArray.from_buffers(
        len(order),
        pa.py_buffer(np.concatenate([[0], np.cumsum(segment_bytes)]).astype(np.int64).tobytes()),
        pa.py_buffer(body[_flat(low[order], segment_bytes)].tobytes()),
    )
    words = words_of_texts(texts)
    size = np.diff(words.first)
    _, numbers = np.unique(words.hashes, return_inverse=True)
    numbers = numbers + 1
    # Equal segments are one piece of the index, with the smallest doc_id that has it.
    power = _powers(len(numbers))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes * power[0])])
    digest = mixed((sums[words.first[1:]] - sums[words.first[:-1]]) * power[1][words.first[:-1]] + size.astype(np.uint64) * GOLDEN)
    _, piece, of = np.unique(digest, return_index=True, return_inverse=True)
    owner = np.full(len(piece), np.iinfo(np.int64).max)
    np.minimum.at(owner, of, columns["doc"][order])
    begins, sizes = words.first[:-1][piece], size[piece]
    ends = np.cumsum(sizes + 1)
    at = ends - sizes - 1
    text = np.zeros(ends[-1], np.int64)
    text[_flat(at, sizes)] = numbers[_flat(begins, sizes)]
    index = FMIndex(text)
    owner_at = np.repeat(owner, sizes + 1)[index.order]
    n_windows = sizes - window + 1
    places = _flat(at, n_windows)
    least = np.empty(len(places), np.int64)
    for k in range(0, len(places), QUERIES_AT_ONCE):
        some = places[k : k + QUERIES_AT_ONCE]
        low_high = index.intervals(text[some[:, None] + np.arange(window)])
        least[k : k + QUERIES_AT_ONCE] = _least_between(owner_at, *low_high)
    # Every document that has a segment loses the windows an earlier document has.
    first_window = np.cumsum(n_windows) - n_windows
    count = n_windows[of]
    row = np.repeat(np.arange(len(order)), count)
    offset = _flat(np.zeros(len(order), np.int64), count)
    gone = least[first_window[of][row] + offset] < columns["doc"][order][row]
    row, offset = row[gone], offset[gone]
    if len(row):
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)
        edge = np.flatnonzero(new)
        run = np.diff(np.append(edge, len(row)))
        entry = order[row[edge]]
        found.append(
            {
                "doc": columns["doc"][entry],
                "key": columns["key"][entry],
                "start": columns["start"][entry] + offset[edge],
                "size": run + window - 1,
            }
        )
    return {c: np.concatenate([f[c] for f in found]) for c in found[0]}


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of ``values[low:high]`` for ranges that are equal or apart."""
    begin, which = np.unique(low, return_inverse=True)
    end = np.empty(len(begin), np.int64)
    end[which] = high
    cuts = np.stack([begin, end], axis=1).ravel()
    padded = np.append(values, np.iinfo(np.int64).max)
    return np.minimum.reduceat(padded, cuts)[::2][which]


def removed_stretches(docs: DataFrame, window: int = WINDOW, docs_a_shard: int = DOCS_A_SHARD) -> DataFrame:
    """``doc_id, key, start, size``: word ranges to remove, which may overlap. ``key`` is a hash
    of the text and tells rows of one doc_id apart."""
    if not 1 <= window <= DEPTH:
        raise ValueError(f"the index tells windows of 1 to {DEPTH} words apart, not {window}")
    small_batches_for(docs.sparkSession)
    n_shards = max(1, -(-docs.count() // docs_a_shard))
    rows = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text"
    )
    blobs = rows.mapInArrow(lambda batches: _cut(batches, window, n_shards), "shard int, blob binary")

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        found = _matched(list(frame["blob"]), window)
        return pd.DataFrame(
            {
                "doc_id": found["doc"],
                "key": found["key"],
                "start": found["start"].astype(np.int32),
                "size": found["size"].astype(np.int32),
            }
        )

    return blobs.groupBy("shard").applyInPandas(search, "doc_id long, key long, start int, size int")


def substring_dedup(docs: DataFrame, text: str = "text", window: int = WINDOW, docs_a_shard: int = DOCS_A_SHARD) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, the words left joined by one
    space; columns of those names are replaced.

    Documents without a doc_id neither lose words nor take any away; rows of one doc_id do not
    take any from each other. A null text counts as empty. An empty table gives an empty result.
    """
    names = ("n_words", "n_removed", "kept_text")
    columns = [c for c in docs.columns if c not in names]
    base = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in columns if c != text]).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text).alias("same"),
        F.col(text).alias("text"),
    )
    stretches = (
        removed_stretches(docs.select("doc_id", F.col(text).alias("text")), window, docs_a_shard)
        .groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("start", "size")).alias("gone"))
    )
    # Segments are many times the stretches found in them: done with before texts move.
    stretches = written(docs.sparkSession, stretches, "substring-stretches")
    release_shuffles(docs.sparkSession)
    joined = base.join(
        stretches, (F.col("id") == F.col("doc_id")) & (F.col("same") == F.col("key")), "left"
    ).select(
        "row",
        "text",
        F.transform("gone", lambda g: g["start"]).alias("starts"),
        F.transform("gone", lambda g: g["size"]).alias("sizes"),
    )
    kept_words = F.pandas_udf(_kept, "n_words long, n_removed long, kept_text string")
    kept = joined.select("row", "text", kept_words("text", "starts", "sizes").alias("kept"))
    return kept.select(
        *[(F.col("text") if c == text else F.col("row")[c]).alias(c) for c in columns],
        *[F.col("kept")[c].alias(c) for c in names],
    )


def _kept(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
    rows = []
    for text, start, size in zip(texts, starts, sizes):
        words = text.encode().split() if text else []
        n = len(words)
        if start is not None and len(start):
            steps = np.zeros(n + 1, np.int64)
            np.add.at(steps, start, 1)
            np.add.at(steps, np.asarray(start) + np.asarray(size), -1)
            left = np.cumsum(steps[:n]) == 0
            words = [word for word, stays in zip(words, left) if stays]
        rows.append((n, n - len(words), b" ".join(words).decode()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_text"])
