"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Text is split where the pattern always splits: before a single space that a non-space follows, and before a line
end that stands alone or in a pair. The distinct parts of a block of texts are found by Arrow; each is encoded once by
the library and remembered in the worker (a bounded memo of parts, not of documents), and the ids of all texts are
gathered from those of the parts. A text with other runs of white space goes to the library whole. Both give the ids
of the whole text.

Decoding reverses the byte table: every id names a string of stand-in characters, each stand-in is one byte, and
the bytes of all ids are joined before they are read as UTF-8, so characters split between ids come out whole.

Defined results
* Null text counts as empty: no ids, the SHA-256 of nothing, n_tokens 0. Null doc_id is kept.
* Very long texts are encoded whole. Repeated rows give repeated results. An empty table gives no rows.
* Strings of special tokens are ordinary text. Ids outside the vocabulary raise ValueError when decoded.
* `encode` keeps the input's columns; its own (ids, n_tokens, offsets) replace columns of those names.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, table

#: Parts that a worker remembers, in two halves, and the longest part that it does.
MEMO_PARTS, MEMO_LENGTH = 500_000, 64
_FIRST = re.compile(r"[ \n]|\Z")
#: How many letters of new parts the library gets as one text, how many such texts go into a call, and how many bytes
#: of texts are worked on at once.
_CALL, _CALLS, BLOCK_BYTES = 2000, 64, 4_000_000


def blocks(texts: pa.Array, most: int = BLOCK_BYTES):
    """Slices of a batch of texts with a bounded number of bytes, one text at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    at, ends = 0, np.cumsum(sizes)
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield slice(at, to)
        at = to


def gathered(flat: np.ndarray, lengths: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `flat` (one after another, of these lengths) that `picks` names, one after another, and the places
    at which each begins and the last ends."""
    n = lengths[picks]
    to = np.concatenate([[0], np.cumsum(n)])
    shift = (np.cumsum(lengths) - lengths)[picks] - to[:-1]
    return flat[np.arange(to[-1]) + np.repeat(shift, n)], to


def byte_table() -> list[str]:
    """The stand-in character of each byte: printable bytes stand for themselves, the rest follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    own, out, k = set(shown), [], 0
    for b in range(256):
        out.append(chr(b) if b in own else chr(256 + k))
        k += b not in own
    return out


def _merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs of known strings that join to a known string, by the rank of what they make."""
    return [(t[:i], t[i:]) for t, _ in sorted(ranks.items(), key=lambda x: x[1]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]


def _mixed(column: pa.Array, parts: list[str], picks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which texts have white space elsewhere than where the pattern always splits, by their parts (an Arrow column and
    a list of the same): a part after the first that is empty or begins with white space, but for a line end before a
    non-space, and for a line end alone that ends the text or stands before such a part. `picks` has the parts of all
    texts, which begin at `starts`."""
    initial = pc.utf8_slice_codeunits(column, 0, 1)
    odd = np.asarray(pc.or_(pc.utf8_is_space(initial), pc.equal(initial, "")))
    line = np.zeros(len(parts), dtype=bool)
    alone = np.zeros(len(parts), dtype=bool)
    for i in np.flatnonzero(odd).tolist():
        line[i] = len(parts[i]) > 1 and parts[i][0] == "\n" and not parts[i][1].isspace()
        alone[i] = parts[i] == "\n"
    odd = odd & ~line
    bad = odd[picks]
    bad[starts[:-1]] = False
    ends = np.zeros(len(picks), dtype=bool)
    ends[starts[1:] - 1] = True
    at = np.flatnonzero(bad & alone[picks])
    bad[at] = ~(ends[at] | line[picks[np.minimum(at + 1, len(picks) - 1)]])
    return np.logical_or.reduceat(bad, starts[:-1]) if len(starts) > 1 else np.zeros(0, dtype=bool)


def _spaced(part: str) -> str:
    """A part as it stands in its text: line ends are part of it, spaces are not."""
    return part if part[0] == "\n" else " " + part


class Memo(dict):
    """The ids of parts. When the younger half is full it becomes the older one, which is let go; a part found in the
    older half moves to the younger. A part found in neither reads as None and is listed in `new`."""

    def __init__(self):
        self.older: dict[str, bytes] = {}
        self.new: list[str] = []

    def __missing__(self, part: str) -> bytes | None:
        found = self.older.get(part)
        if found is None:
            self.new.append(part)
        elif len(part) <= MEMO_LENGTH:
            self[part] = found
        return found

    def age(self) -> None:
        """Lets the older half go if the younger is full."""
        if len(self) > MEMO_PARTS // 2:
            self.older = dict(self)
            self.clear()


class Codec:
    """Encoder and decoder of one vocabulary: ids as unsigned 32-bit integers."""

    def __init__(self, tokenizer, id_bytes: list[bytes]):
        self.tokenizer = tokenizer
        tokenizer.encode_special_tokens = True
        self.id_bytes = id_bytes
        self.lengths = np.array([len(b) for b in id_bytes], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(id_bytes), dtype=np.uint8)
        self.memo = Memo()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learned(self, parts: list[str]) -> list[bytes]:
        """The ids of parts, each after its space or line end, many in one call; byte lengths tell their ids apart."""
        if not parts:
            return []
        column = pa.array(parts, pa.string())
        sizes = np.asarray(pc.binary_length(column)) + np.int64(1) - np.asarray(pc.starts_with(column, "\n"))
        call = np.cumsum(sizes) // _CALL
        edges = [0, *(np.flatnonzero(np.diff(call)) + 1).tolist(), len(parts)]
        ids = []
        for i in range(0, len(edges) - 1, _CALLS):  # few at a time, as the library's answers are large
            some = ["".join(map(_spaced, parts[a:b])) for a, b in zip(edges[i : i + _CALLS], edges[i + 1 :], strict=False)]
            ids += [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        ids = np.concatenate(ids)
        to = (np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes), side="left") + 1) * 4
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *to.tolist()], to.tolist(), strict=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the places at which each text's begin and the last's end. Null
        texts are empty."""
        rows = texts.to_pylist()
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\n", " \n"), " ")
        starts = np.asarray(split.offsets)
        parts = split.flatten().dictionary_encode()
        distinct = pc.cast(parts.dictionary, pa.string()).to_numpy(zero_copy_only=False).tolist()
        picks = np.asarray(parts.indices).astype(np.int64)
        mixed = _mixed(parts.dictionary, distinct, picks, starts)
        if mixed.any():  # such a text is one part of its own
            kept = ~np.repeat(mixed, np.diff(starts))
            kept[starts[:-1]] = True
            picks, starts = picks[kept], np.concatenate([[0], np.cumsum(np.where(mixed, 1, np.diff(starts)))])
        # first parts follow no space, so they are places of their own after the distinct parts
        first = [t if m or not t else t[: _FIRST.search(t).start()] for t, m in zip(rows, mixed.tolist(), strict=True)]
        picks[starts[:-1]] = len(distinct) + np.arange(len(rows))
        uses = np.bincount(picks, minlength=len(distinct) + len(rows))[: len(distinct)]
        memo = self.memo
        got = [memo[p] if n else b"" for p, n in zip(distinct, uses.tolist(), strict=True)]
        learned = self._learned(memo.new)
        where = [i for i, g in enumerate(got) if g is None]
        for i, g in zip(where, learned, strict=True):
            got[i] = g
        # those used once here are the least likely to come again
        again = (uses[where] > 1).tolist()
        memo.update((p, g) for p, g, more in zip(memo.new, learned, again, strict=True) if more and len(p) <= MEMO_LENGTH)
        memo.new = []
        memo.age()
        got += [self.whole(p) if p else b"" for p in first]
        column = pa.array(got, pa.large_binary())
        flat = np.frombuffer(column.buffers()[2] or b"", dtype="<u4")
        ids, to = gathered(flat, np.asarray(pc.binary_length(column)) // 4, picks)
        del column, flat, split, parts
        pa.default_memory_pool().release_unused()  # workers are kept, and would keep it
        return ids, to[starts]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that ids stand for, and the places at which those of the id numbers `at` begin."""
        if len(ids) and int(ids.max()) >= len(self.id_bytes):
            raise ValueError("an id is outside the vocabulary")
        raw, to = gathered(self.flat, self.lengths, ids.astype(np.int64))
        return raw, to[at]

    def offsets(self, ids: np.ndarray, text: str) -> np.ndarray:
        """Where each id begins and ends in the text, in characters: rows (from, to). An id that holds a part of a
        character counts as reaching over all of it."""
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        starts = np.concatenate([(raw & 0xC0) != 0x80, [True]])
        char = np.cumsum(starts) - 1
        end = np.cumsum(self.lengths[ids])
        begin = np.concatenate([[0], end[:-1]]).astype(np.int64) if len(end) else end
        return np.stack([char[begin], char[end] + ~starts[end]], axis=1) if len(end) else np.zeros((0, 2), np.int64)


def _from_ranks(path: str, pattern: str) -> Codec:
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}
    chars = byte_table()
    shown = lambda b: "".join(map(chars.__getitem__, b))
    model = models.BPE(vocab={shown(t): r for t, r in ranks.items()}, merges=[(shown(a), shown(b)) for a, b in _merges(ranks)], ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), behavior="isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return Codec(tokenizer, _id_bytes(tokenizer))


def _id_bytes(tokenizer) -> list[bytes]:
    """What each id stands for: the byte table reversed."""
    back = {c: b for b, c in enumerate(byte_table())}
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for text, i in vocab.items():
        out[i] = bytes(back[c] for c in text) if all(c in back for c in text) else text.encode()
    return out


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str | None = None) -> Codec:
    """The codec of a vocabulary file, made once in each worker: ranks if a pattern is given, else a tokenizers file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core
    if pattern is not None:
        return _from_ranks(path, pattern)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return Codec(tokenizer, _id_bytes(tokenizer))


def encode(docs: DataFrame, path: str, pattern: str | None = None, text: str = "text", offsets: bool = False) -> DataFrame:
    """docs with ids array<int> and n_tokens long added, and with offsets array<struct<start,end>> in characters if
    asked for. No shuffle; a batch of rows at a time."""
    own = ["ids", "n_tokens", "offsets"][: 3 if offsets else 2]
    base = docs.drop(*[c for c in docs.columns if c.lower() in own and c != text])
    kept = base.columns if text.lower() not in own else [c for c in base.columns if c != text]
    t = free_name(base, "_t")
    source = base.withColumn(t, F.coalesce(F.col(text), F.lit(""))).select(*kept, t)
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    if offsets:
        added.append(T.StructField("offsets", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))))

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for s in blocks(texts):
                some = texts[s]
                ids, at = c.encode(some)
                cols = [batch.column(i)[s] for i in range(batch.num_columns - 1)]
                where = pa.array(at.astype(np.int32))
                cols += [pa.ListArray.from_arrays(where, pa.array(ids.view("<i4"), pa.int32())), pa.array(np.diff(at))]
                if offsets:
                    each = [c.offsets(ids[a:b], t) for a, b, t in zip(at.tolist(), at[1:].tolist(), some.to_pylist(), strict=False)]
                    o = np.concatenate(each).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(where, pa.StructArray.from_arrays([pa.array(o[:, 0]), pa.array(o[:, 1])], ["start", "end"])))
                yield pa.RecordBatch.from_arrays(cols, [*kept, *own])

    return source.mapInArrow(run, T.StructType([*[source.schema[c] for c in kept], *added]))


def decode(docs: DataFrame, path: str, pattern: str | None = None, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """docs with the text of an id column added; bytes that are no UTF-8 become U+FFFD. Null ids give null."""
    base = docs.drop(*[c for c in docs.columns if c.lower() == to.lower() and c != ids])
    schema = T.StructType([*base.schema.fields, T.StructField(to, T.StringType())])
    at = base.columns.index(ids)

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            found = [None if x is None else c.decode(np.array(x, dtype="<u4"), np.zeros(0, np.int64))[0].tobytes().decode("utf-8", "replace") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], schema.names)

    return base.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes each text and decodes its ids: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids array<int> if they
    are wanted too. No shuffle."""
    source = docs.select(docs[doc_id], F.coalesce(docs[text], F.lit("")).alias("text"))
    fields = [source.schema[doc_id], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType([*fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])

    def run(batches):
        c, sha = codec(path, pattern), hashlib.sha256
        for batch in batches:
            for part in blocks(batch.column(1)):
                ids, at = c.encode(batch.column(1)[part])
                raw, to = c.decode(ids, at)
                hashes = lambda x, edges: [sha(x[a:b]).hexdigest() for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
                own, back = hashes(memoryview(ids).cast("B"), 4 * at), hashes(memoryview(raw), to)
                cols = [batch.column(0)[part], pa.array(np.diff(at)), pa.array(own, pa.string()), pa.array(back, pa.string())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view("<i4"), pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, schema.names)

    return source.mapInArrow(run, schema)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the ranks of the public 50k vocabulary."""
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
