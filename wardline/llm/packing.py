"""Hierarchical multi-length packing of tokenised documents.

Documents longer than the longest context give whole windows of it.  The rest of
each document is routed to the shortest context tier that holds it.  Each tier's
sequences are opened by its own longest pieces; their gaps are filled by the
longest pieces of shorter tiers that fit, and where none fits exactly, by cutting
the shortest one, so that a sequence is full before the next is opened.  What is
open when a task ends is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import functools
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import chunks, in_arrow

LONGEST, SHORTEST = 1024, 128
#: Tokens of a step group.
STEP = 16 * LONGEST
END = 0
SPECIAL = {"<|endoftext|>": 50256}


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.cache
def _encoding(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_ids(text: str, path: str | None = None) -> np.ndarray:
    """The ids ``tokenizers`` gives with the same vocabulary (byte_bpe_50k.json,
    add_special_tokens=False), from the several times faster ``tiktoken``."""
    return _encoding(path or vocabulary()).encode_to_numpy(text, allowed_special="all", disallowed_special=())


class Packer:
    """Packs blocks of documents; keeps only the one open sequence between blocks.

    A piece is (document's ids, start, length, key), a sequence (tier, pieces).
    """

    def __init__(self, longest: int = LONGEST, shortest: int = SHORTEST):
        self.longest, self.shortest = longest, shortest
        self.open: list | None = None
        self.gap = 0
        self.tier = 0

    def _tier(self, n: int) -> int:
        return min(self.longest, max(self.shortest, 1 << (n - 1).bit_length()))

    def block(self, docs: list[tuple]) -> Iterator[tuple[int, list]]:
        """``docs``: (key, ids).  Yields the sequences that are full."""
        pool = []  # (length, order, key, ids, start), shortest first
        for order, (key, ids) in enumerate(docs):
            whole = len(ids) - len(ids) % self.longest
            for a in range(0, whole, self.longest):
                yield self.longest, [(key, ids, a, self.longest)]
            if len(ids) > whole:
                pool.append((len(ids) - whole, order, key, ids, whole))
        pool.sort(key=lambda p: p[:2])
        while pool:
            if self.open is None:
                n, _, key, ids, a = pool.pop()
                self.tier = self._tier(n)
                self.open, self.gap = [(key, ids, a, n)], self.tier - n
            while self.gap and pool:
                at = bisect_right(pool, self.gap, key=lambda p: p[0])
                if at:
                    n, _, key, ids, a = pool.pop(at - 1)
                else:
                    size, order, key, ids, a = pool.pop(0)
                    n = self.gap
                    insort(pool, (size - n, order, key, ids, a + n), key=lambda p: p[:2])
                self.open.append((key, ids, a, n))
                self.gap -= n
            if not self.gap:
                yield self.tier, self.open
                self.open = None

    def rest(self) -> Iterator[tuple[int, list]]:
        """The open sequence, cut into powers of two."""
        left = sum(p[3] for p in self.open) if self.open else 0
        pieces = list(reversed(self.open or ()))
        while left:
            size = 1 << (left.bit_length() - 1)
            need, out = size, []
            while need:
                key, ids, a, n = pieces.pop()
                take = min(n, need)
                out.append((key, ids, a, take))
                need -= take
                if take < n:
                    pieces.append((key, ids, a + take, n - take))
            yield size, out
            left -= size
        self.open = None


def _step_groups(sequences: list[tuple[int, list]], step: int) -> list[int]:
    """For each sequence a group of its tier, each group with as many sequences
    (``step`` tokens) and about the same attention work: the most costly first,
    dealt to and fro."""
    group = [0] * len(sequences)
    for tier in {t for t, _ in sequences}:
        own = sorted((i for i, s in enumerate(sequences) if s[0] == tier), key=lambda i: -sum(p[3] ** 2 for p in sequences[i][1]))
        n = -(-len(own) * tier // step)
        for at, i in enumerate(own):
            r, c = divmod(at, n)
            group[i] = c if r % 2 == 0 else n - 1 - c
    return group


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LONGEST, shortest: int = SHORTEST,
         step: int = STEP, path: str | None = None, block: int = 1 << 21) -> DataFrame:
    """Pack all documents into sequences; one row for each piece of a document:

    ``<key>, start, length, doc_tokens, sequence_id, offset, tier, step_group
    long`` and ``ids binary`` (little-endian unsigned 32-bit).

    A document's ids end with id 0, so null and empty texts give one id.  Every
    id is in exactly one piece.  All sequences are as long as their power of two
    ``tier``, so none needs padding; at most ten short ones end a task's share.
    Each task packs its own input partition block by block (no shuffle, memory
    for one block of about ``block`` bytes of text or one document), with ids
    from its partition number, so a rerun task gives the same rows.  Repeated
    rows are documents of their own; a null key is kept; other columns are
    ignored.
    """
    path = path or vocabulary()
    kind = docs.schema[key].dataType.simpleString()
    names = ["start", "length", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]

    def rows(sequences: list, first: int, keys: pa.Array) -> pa.RecordBatch:
        if not sequences:
            return None
        groups, number_of = _step_groups(sequences, step), {}
        cols = {n: [] for n in names}
        parts, at = [], []
        for number, ((tier, pieces), group) in enumerate(zip(sequences, groups, strict=True), first):
            offset = 0
            for k, ids, a, n in pieces:
                at.append(k)
                parts.append(ids[a:a + n])
                for name, v in zip(names, (a, n, len(ids), number, offset, tier, first + number_of.setdefault((tier, group), len(number_of))), strict=True):
                    cols[name].append(v)
                offset += n
        data = np.concatenate(parts).astype("<u4", copy=False)
        ends = np.concatenate(([0], np.cumsum(cols["length"]) * 4)).astype(np.int32)
        ids = pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])
        return pa.RecordBatch.from_arrays([pc.take(keys, pa.array(at, pa.int64())), *(pa.array(cols[n], pa.int64()) for n in names), ids], names=[key, *names, "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = functools.partial(token_ids, path=path)
        packer, number = Packer(longest, shortest), TaskContext.get().partitionId() << 40
        end = np.array([END], np.uint32)
        held = None  # keys of the open sequence's documents
        for batch in batches:
            for part, _, _ in chunks(batch, "t", block):
                texts = pc.fill_null(part.column(1).cast(pa.large_string()), "").to_pylist()
                open_keys = len(held) if held is not None else 0
                keys = pa.concat_arrays([held, part.column(0)]) if open_keys else part.column(0)
                docs_ = [(i, np.concatenate((encode(t), end))) for i, t in enumerate(texts, open_keys)]
                sequences = list(packer.block(docs_))
                if sequences:
                    yield rows(sequences, number, keys)
                    number += len(sequences)
                # renumber what stays open, so that keys do not pile up
                used = sorted({p[0] for p in packer.open or ()})
                place = {k: i for i, k in enumerate(used)}
                packer.open = [(place[p[0]], *p[1:]) for p in packer.open] if packer.open else None
                held = pc.take(keys, pa.array(used, pa.int64()))
        if packer.open:
            yield rows(list(packer.rest()), number, held)

    return docs.select(F.col(key), F.col(text).cast("string").alias("t")).transform(
        in_arrow, run, f"`{key}` {kind}, {', '.join(f'{n} long' for n in names)}, ids binary")
