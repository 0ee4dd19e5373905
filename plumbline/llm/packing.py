"""Sequence packing: first-fit decreasing over a tournament tree, in randomised groups.

1. Every document is encoded where it is read and cut into pieces of ``length`` tokens and a rest.
   Full pieces are sequences of their own; rests are dealt out at random by a hash.
2. Each task packs its rests in groups of up to ``GROUP`` pieces: longest first, each into the first
   bin with room, found by descending a tournament tree whose nodes hold the most room below them.
3. Bins that stay open are topped up: the emptiest bin is taken apart and its pieces, cut where
   needed, fill the gaps of the fullest ones. At most one sequence of a group stays short.

Groups are independent, so packing needs one shuffle of the rests and bounded memory, whatever the
number of documents or the share of one length.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import text_of

LENGTH = 1024
END = 0
GROUP = 8192
LEAST_GAP = 8
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
BLOCK = 256
_SPECIAL = "<|endoftext|>"


# Fixed: letters and marks of old standing, on whose classes all versions of the pattern's engine agree.
_OLD = "[\x00-\u024f\u0386-\u03ce\u0400-\u0481\u2010-\u2027\u2030-\u205e\u20a0-\u20b5\u3001\u3002\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]*"


class Encoder:
    """Ids of a text under the public byte-level vocabulary, as the tokenizer file defines them.

    The same vocabulary as ranks is several times faster, so it encodes what both read alike; texts
    with other letters or the special string go to the tokenizer itself.
    """

    def __init__(self, folder: str | None = None):
        import base64
        import os

        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        def path(name):
            return os.path.join(folder, name) if folder else public_tokenizers.path(name)

        self.whole = Tokenizer.from_file(path(TOKENIZER))
        with open(path(RANKS), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.old = regex.compile(_OLD)

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 16-bit ids; the vocabulary has fewer than 65,536."""
        import numpy as np

        if _SPECIAL in text or not self.old.fullmatch(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u2").tobytes()


_encoders: dict[str | None, Encoder] = {}


def encoder(folder: str | None = None) -> Encoder:
    """One encoder for each worker process."""
    if folder not in _encoders:
        _encoders[folder] = Encoder(folder)
    return _encoders[folder]


class Tournament:
    """Room of each bin at the leaves, the most room below at every node."""

    def __init__(self, bins: int, room: int):
        self.size = 1
        while self.size < max(1, bins):
            self.size *= 2
        self.most = [room] * (2 * self.size)

    def take(self, need: int) -> int:
        """The first bin with that much room, which it then has less; one bin for each piece is there."""
        at, most = 1, self.most
        while at < self.size:
            at *= 2
            if most[at] < need:
                at += 1
        bin_ = at - self.size
        most[at] -= need
        at //= 2
        while at:
            left, right = most[2 * at], most[2 * at + 1]
            now = left if left > right else right
            if most[at] == now:
                break
            most[at] = now
            at //= 2
        return bin_


def first_fit_decreasing(lengths: list[int], room: int = LENGTH) -> list[list[int]]:
    """Numbers of the pieces in each bin."""
    tree, bins = Tournament(len(lengths), room), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = tree.take(lengths[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def topped_up(bins: list[list[int]], lengths: list[int], room: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Bins of ``(piece, from, to)``: the emptiest are taken apart to fill the gaps of the others."""
    filled = [[(i, 0, lengths[i]) for i in b] for b in bins]
    gap = [room - sum(lengths[i] for i in b) for b in bins]
    order = sorted((b for b in range(len(bins)) if gap[b] >= LEAST_GAP), key=lambda b: gap[b])
    low, high = 0, len(order) - 1
    while low < high:
        target, source = order[low], order[high]
        piece, start, end = filled[source].pop()
        cut = min(gap[target], end - start)
        filled[target].append((piece, start, start + cut))
        gap[target] -= cut
        gap[source] += cut
        if start + cut < end:
            filled[source].append((piece, start + cut, end))
        if gap[target] < LEAST_GAP:
            low += 1
        if not filled[source]:
            high -= 1
    return [b for b in filled if b]


_PIECE = "doc_id long, start long, n long, doc_tokens long, full boolean, crc long, ids binary"
_OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _wide(ids: bytes) -> bytes:
    """From 16 to 32 bits an id."""
    import numpy as np

    return np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def _cut(length: int, folder: str | None, with_ids: bool):
    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        encode = encoder(folder)
        kind = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("doc_tokens", pa.int64()),
                          ("full", pa.bool_()), ("crc", pa.int64()), ("ids", pa.binary())])
        end = END.to_bytes(2, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part, rows = batch.slice(at, BLOCK), []
                docs = part.column(0).to_pylist()
                for doc, text in zip(docs, part.column(1)):
                    ids = encode(text.as_py() or "") + end
                    n = len(ids) // 2
                    for s in range(0, n, length):
                        own = ids[2 * s:2 * (s + length)]
                        full = n - s >= length
                        # a full piece is final: without its ids only their digest travels
                        rows.append((doc, s, min(length, n - s), n, full, zlib.crc32(_wide(own)), own if with_ids or not full else b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kind)], schema=kind)
    return run


def _pack(length: int, group: int, with_ids: bool):
    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        kind = pa.schema([(c, pa.int64()) for c in names] + ([("ids", pa.binary())] if with_ids else []))
        sequence = TaskContext.get().partitionId() << 40
        rest: list[tuple] = []

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kind)], schema=kind)

        def packed(pieces):
            nonlocal sequence
            lengths = [p[2] for p in pieces]
            rows = []
            for content in topped_up(first_fit_decreasing(lengths, length), lengths, length):
                offset = 0
                for i, a, b in content:
                    doc, start, n, tokens, crc, ids = pieces[i]
                    whole = b - a == n
                    own = _wide(ids[2 * a:2 * b]) if with_ids or not whole else b""
                    rows.append((doc, start + a, b - a, crc if whole else zlib.crc32(own), tokens, sequence, offset) + ((own,) if with_ids else ()))
                    offset += b - a
                sequence += 1
            return made(rows)

        for batch in batches:
            rows = []
            for doc, start, n, tokens, full, crc, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if full:
                    rows.append((doc, start, n, crc, tokens, sequence, 0) + ((_wide(ids),) if with_ids else ()))
                    sequence += 1
                else:
                    rest.append((doc, start, n, tokens, crc, ids))
            if rows:
                yield made(rows)
            while len(rest) >= 2 * group:  # never a small last group
                yield packed(rest[:group])
                del rest[:group]
        if rest:
            yield packed(rest)
    return run


def pack(docs: DataFrame, length: int = LENGTH, group: int = GROUP, text: str = "text", with_ids: bool = False,
         folder: str | None = None) -> DataFrame:
    """All documents as pieces of sequences of up to ``length`` tokens.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with
    ``with_ids``, the ids as little-endian unsigned 32-bit numbers. Every document's ids end with
    id 0; null and empty texts consist of that id alone. Repeated rows are packed each. An empty
    table gives no rows. ``folder`` holds the tokenizer's files. No other column is read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    pieces = rows.mapInArrow(_cut(length, folder, with_ids), _PIECE)
    # The deal depends on content only, so a task that runs again deals as before.
    deal = F.xxhash64("doc_id", "start", "doc_tokens", "crc")
    return pieces.repartition(deal).mapInArrow(_pack(length, group, with_ids), _OUT + (", ids binary" if with_ids else ""))


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids, n_tokens)`` from pieces that carry their ids: at most ``length`` tokens each."""
    parts = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens"))
    # binary values have no concat in an aggregate; hex digits do
    joined = F.unhex(F.concat_ws("", F.transform("parts", lambda p: F.hex(p["ids"]))))
    return parts.select("sequence_id", joined.alias("ids"), "n_tokens")
