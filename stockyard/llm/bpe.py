"""Byte-level BPE with a local rank file: encode, digest, decode.

The tiktoken library does the merges.  Long texts are cut first where no match of the
pattern can span (before a space that follows an ASCII letter or digit), and parts with very long
runs, on which its pair scan is quadratic, are merged here with a heap.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Shared, col

#: Texts above this many characters are cut at safe boundaries.
PART_CHARS = 1 << 16
#: A part with a run of this many characters without or of white space is merged with the heap.
LONG_RUN = 1 << 11


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes from a rank file (base64 token, space, rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def cuts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut only at safe boundaries.

    No match spans the place between an ASCII letter or digit and a space, and what is matched
    on either side does not depend on the other, so the parts encode as the whole does.
    """
    at = 0
    while len(text) - at > size:
        end = text.find(" ", at + size)
        while end > 0 and not (text[end - 1].isascii() and text[end - 1].isalnum()):
            end = text.find(" ", end + 1)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


class Codec:
    """Encoder and decoder over one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.run = regex.compile(r"\S{%d,}|\s{%d,}" % (LONG_RUN, LONG_RUN))

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost first, over one match, in O(n log n)."""
        ranks, n = self.ranks, len(piece)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))  # end of the part that begins here; 0: merged away
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(piece[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, stop = heapq.heappop(heap)
            other = nxt[k] if end[k] else n
            if not end[k] or other >= n or end[other] != stop:
                continue  # one of the two has been merged since
            end[k], end[other], nxt[k] = stop, 0, nxt[other]
            if nxt[k] < n:
                prv[nxt[k]] = k
                if (r := ranks.get(piece[k : end[nxt[k]]])) is not None:
                    heapq.heappush(heap, (r, k, end[nxt[k]]))
            if prv[k] >= 0 and (r := ranks.get(piece[prv[k] : stop])) is not None:
                heapq.heappush(heap, (r, prv[k], stop))
        out, k = [], 0
        while k < n:
            out.append(ranks[piece[k : end[k]]])
            k = nxt[k]
        return out

    def encode(self, text: str) -> list[int]:
        if len(text) < LONG_RUN:
            return self.encoding.encode_ordinary(text)
        out: list[int] = []
        for part in cuts(text):
            if self.run.search(part) is None:
                out += self.encoding.encode_ordinary(part)
                continue
            for m in self.pattern.finditer(part):
                raw = m[0].encode()
                out += [self.ranks[raw]] if raw in self.ranks else self.merge(raw)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)


ENCODED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def _run(ranks: Shared, pattern: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ranks.get(lambda value: Codec(value, pattern))
        digits = [b"%d" % k for k in range(max(codec.ranks.values()) + 1)]
        for batch in batches:
            # Small slices keep the token lists of a batch small.
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                counts, lists, sha, back = [], [], [], []
                for text in part.column(0).to_pylist():
                    ids = codec.encode(text or "")
                    counts.append(len(ids))
                    lists.append(ids if keep_ids else None)
                    sha.append(hashlib.sha256(b" ".join([digits[k] for k in ids])).hexdigest())
                    back.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                made = [pa.array(counts, pa.int64()), pa.array(lists, pa.list_(pa.int32())), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *made], names=[*part.schema.names[1:], *ENCODED.names])

    return run


def encode(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, ..., n_tokens, ids, ids_sha256, decoded_sha256) for every row of ``docs``.

    ids are the token ids without special tokens, ids_sha256 digests them as decimals joined by
    a space, decoded_sha256 digests the bytes that decode from them.  A null text counts as
    empty: no tokens.  Rows are independent, nothing is shuffled; the rank table (fixed size)
    is broadcast, so workers need no file.  ``keep_ids=False`` leaves ids null; ``carry`` names
    further columns to take along.
    """
    ranks = Shared(docs, "codec", read_ranks(rank_file))
    src = docs.select(col(text_col).alias("_text"), col(id_col).cast("long").alias("doc_id"), *[col(c) for c in carry])
    return src.mapInArrow(_run(ranks, pattern, keep_ids), T.StructType([*src.schema.fields[1:], *ENCODED.fields]))


def decode(encoded: DataFrame, rank_file: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` plus ``decoded``: the raw bytes of each row's ids (null ids: null)."""
    ranks = Shared(encoded, "token bytes", read_ranks(rank_file))

    @F.pandas_udf(T.BinaryType())
    def raw(ids: pd.Series) -> pd.Series:
        table = ranks.get(lambda value: {k: token for token, k in value.items()})
        return ids.map(lambda x: None if x is None else b"".join([table[k] for k in x]))

    return encoded.withColumn("decoded", raw(col(ids_col)))
