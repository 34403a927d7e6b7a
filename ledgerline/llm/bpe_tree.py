"""Byte-level BPE encoding and decoding by tree concatenation.

Ids are those of the tokenizers library with its defaults (strings of special
tokens in a text are their one id) and no added special tokens. The
pre-tokenizer splits a text into pre-tokens, which merges never cross. A long text that the pre-tokenizer
leaves in one piece is cut into leaves of ``LEAF_BYTES``; halves are encoded apart and
joined pairwise: around each join the last and first k tokens are encoded anew as one
window, and k doubles until the window begins with the left side's token and
ends with the right side's. A sequence of tokens is the encoding of its bytes as
soon as each two neighbours are the encoding of theirs, so a join that both
sides agree on is exact.

Scale: a text of up to ``long_chars`` is encoded where it was read, without a shuffle. A longer one is cut into parts (at unit
boundaries where there are any, else inside pre-tokens), the parts are dealt over all tasks,
encoded in parallel, and joined document by document; parts are written once, so a lost task
reads them again. A document's ids must fit a row, as its text does. Time and memory are
linear in the length of a text, whatever it holds: about 60 bytes a character of one text's longest stretch without a space.

Defined results: a null or empty text has no tokens and decodes to the empty text;
repeated rows give repeated rows; an empty table gives no rows; null ids (doc_id) are kept; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, materialize, table

LEAF_BYTES = 16_384  # a longer pre-token is encoded as a tree of leaves
PIECE_BYTES = 262_144  # the bytes of one pre-token that one part of a long text holds
PART_CHARS = 262_144  # the characters of a part of a long text
LONG_CHARS = 1_048_576  # longer texts are spread over tasks
SLICE_CHARS = 65_536  # characters that the pre-tokenizer is given at once
OUT_BYTES = 16 << 20  # bytes of an output batch


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_chars() -> dict[str, int]:
    """The printable character that a byte-level BPE file writes for each byte:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def units_of(text: str) -> list[str]:
    """The text cut before each space that a non-space follows. No pre-token crosses
    such a place, so units can be encoded one by one."""
    head, *parts = text.split(" ")
    units, run = [], [head]
    for p in parts:
        if p and not p[0].isspace():
            units.append(run[0] if len(run) == 1 else " ".join(run))
            run = [" " + p]
        else:
            run.append(p)
    units.append(" ".join(run))
    return units


class Codec:
    """Texts to ids (little-endian unsigned 32-bit integers) and back."""

    def __init__(self, path: str, leaf_bytes: int = LEAF_BYTES):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte_of = byte_chars()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        # the same merges as the library's: they are in the order of the ids
        self.bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.encode_bytes = self.bpe._encode_single_piece  # one pre-token's bytes to ids
        self.pre = Tokenizer.from_file(path).pre_tokenizer
        self.leaf_bytes = leaf_bytes
        self.bytes_of = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.bytes_of[i] = token
        names = sorted(self.special, key=lambda s: -len(s))
        self.splits = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.unit_chars = leaf_bytes // 4  # UTF-8 has up to four bytes a character
        self.long_unit = re.compile(rf"[^ ]{{{self.unit_chars}}}|\s{{{self.unit_chars}}}")

    # --- long pre-tokens -----------------------------------------------------------------

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of two neighbouring runs of bytes of one pre-token, from the ids of each."""
        k = 4
        while left and right:
            ends = left[-k:], right[:k]
            window = self.encode_bytes(b"".join(map(self.bytes_of.__getitem__, ends[0] + ends[1])))
            if (k >= len(left) or window[0] == ends[0][0]) and (k >= len(right) or window[-1] == ends[1][-1]):
                return left[:-k] + window + right[k:]
            k *= 2
        return left + right

    def concatenate(self, runs: list[list[int]]) -> list[int]:
        """Joins the encoded runs of one pre-token pairwise, level by level."""
        while len(runs) > 1:
            runs = [self.join(*runs[i : i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
        return runs[0] if runs else []

    def tree(self, piece: bytes) -> list[int]:
        leaf = self.leaf_bytes
        return self.concatenate([self.encode_bytes(piece[i : i + leaf]) for i in range(0, len(piece), leaf)])

    def pre_tokens(self, text: str) -> Iterator[str]:
        """The pre-tokens of a long text, a slice at a time: all of a slice's but its last two
        don't depend on what follows, so the next slice starts there."""
        at, size, n = 0, SLICE_CHARS, len(text)
        while at < n:
            part = text[at : at + size]
            spans = [span for _, span in self.pre.pre_tokenize_str(part)]
            if at + size >= n:
                yield from (part[a:b] for a, b in spans)
                return
            if len(spans) < 3:
                size *= 2
                continue
            yield from (part[a:b] for a, b in spans[:-2])
            at += spans[-2][0]
            size = SLICE_CHARS

    # --- whole texts -----------------------------------------------------------------------

    def short(self, text: str) -> bytes:
        """The ids of a text without long units or strings of special tokens."""
        return self.bpe.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def long(self, unit: str) -> bytes:
        ids: list[int] = []
        for p in self.pre_tokens(unit):
            ids += self.tree(p.encode())
        return np.array(ids, "<u4").tobytes()

    def ordinary(self, text: str) -> list[bytes]:
        """The ids of a text without strings of special tokens, in parts to be joined."""
        if not self.long_unit.search(text):
            return [self.short(text)]
        found, held = [], []
        for unit in units_of(text):
            if len(unit) <= self.unit_chars:
                held.append(unit)
                continue
            found += [self.short("".join(held)), self.long(unit)]
            held = []
        return [*found, self.short("".join(held))]

    def encode(self, text: str) -> bytes:
        if not self.splits or not self.splits.search(text):
            return b"".join(self.ordinary(text))
        ids = []
        for i, part in enumerate(self.splits.split(text)):
            if i % 2:
                ids.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                ids += self.ordinary(part)
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return self.bpe.decode_bytes(np.frombuffer(ids, "<u4").tolist()).decode("utf-8", "replace")

    # --- long texts in parts -----------------------------------------------------------------

    def cut(self, text: str, part_chars: int = PART_CHARS, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, bytes]]:
        """(run, bytes) of each part of a text, in order. Run 0 is text to be encoded by itself; parts with
        another, equal run number are bytes of one long pre-token, to be encoded and joined."""
        run, held, size = 0, [], 0

        def flush() -> Iterator[tuple[int, bytes]]:
            # white space at the end of a part is encoded alone: what followed it decided where it was
            # split (U+001C to U+001F are spaces to Python, but not to the pre-tokenizer)
            alone = len(held) > 1 and held[-1].isspace() and held[-1][-1] not in "\x1c\x1d\x1e\x1f"
            tail = held[-1:] if alone else []
            for some in (held[: len(held) - len(tail)], tail):
                if some:
                    yield 0, "".join(some).encode()
            held.clear()

        for i, part in enumerate(self.splits.split(text) if self.splits else [text]):
            for unit in [part] if i % 2 else units_of(part):
                whole = i % 2 or len(unit) <= part_chars
                for p in [unit] if whole else self.pre_tokens(unit):
                    if not whole and len(p) > part_chars:
                        yield from flush()
                        run, size, data = run + 1, 0, p.encode()
                        for at in range(0, len(data), piece_bytes):
                            yield run, data[at : at + piece_bytes]
                        continue
                    held.append(p)
                    size += len(p)
                    if size >= part_chars:
                        yield from flush()
                        size = 0
        yield from flush()

    def encode_part(self, run: int, part: bytes) -> bytes:
        return np.array(self.tree(part), "<u4").tobytes() if run else self.encode(part.decode())

    def join_parts(self, runs: list[int], ids: list[bytes]) -> bytes:
        """The ids of a text from the ids of its parts, in order."""
        out, at = [], 0
        while at < len(runs):
            end = at + 1
            while runs[at] and end < len(runs) and runs[end] == runs[at]:
                end += 1
            if end == at + 1:
                out.append(ids[at])
            else:
                out.append(np.array(self.concatenate([np.frombuffer(x, "<u4").tolist() for x in ids[at:end]]), "<u4").tobytes())
            at = end
        return b"".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """This worker's codec of a tokenizer file."""
    return Codec(path)


def batches_of(rows: Iterator[tuple], columns: list[tuple[str, pa.DataType]], out_bytes: int = OUT_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches of rows (lists of values); a batch ends when its text or binary values reach ``out_bytes``."""
    schema = pa.schema(columns)
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if size >= out_bytes or len(held) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def encode_documents(docs: DataFrame, path: str | None = None, long_chars: int = LONG_CHARS, part_chars: int = PART_CHARS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every row."""
    path = path or tokenizer_path()
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    is_long = F.coalesce(F.length("text") > long_chars, F.lit(False))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            kind = b.column(0).type
            texts = b.column(1)
            rows = ((i.as_py(), len(ids := c.encode(t.as_py() or "")) // 4, ids) for i, t in zip(b.column(0), texts, strict=True))
            yield from batches_of(rows, [("doc_id", kind), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            kind = b.column(0).type
            rows = (
                (i.as_py(), key.as_py(), n, run, part)
                for i, t, key in zip(*b.columns, strict=True)
                for n, (run, part) in enumerate(c.cut(t.as_py(), part_chars, piece_bytes))
            )
            yield from batches_of(rows, [("doc_id", kind), ("key", pa.int64()), ("n", pa.int64()), ("run", pa.int64()), ("part", pa.binary())])

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            kind = b.column(0).type
            rows = ((i.as_py(), key.as_py(), n.as_py(), run.as_py(), c.encode_part(run.as_py(), part.as_py())) for i, key, n, run, part in zip(*b.columns, strict=True))
            yield from batches_of(rows, [("doc_id", kind), ("key", pa.int64()), ("n", pa.int64()), ("run", pa.int64()), ("part", pa.binary())])

    def join_document(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("n")
        ids = codec(path).join_parts(parts["run"].to_pylist(), parts["part"].to_pylist())
        return pa.table({"doc_id": parts["doc_id"][:1], "n_tokens": pa.array([len(ids) // 4], pa.int64()), "ids": pa.array([ids], pa.binary())})

    part_type = f"doc_id {id_type}, key long, n long, run long, part binary"
    out_type = f"doc_id {id_type}, n_tokens long, ids binary"
    short = docs.filter(~is_long).mapInArrow(encode, out_type)
    # the key of a long row (its id may be null or repeated) is pinned by writing the parts
    parts = docs.filter(is_long).withColumn("key", F.monotonically_increasing_id()).mapInArrow(cut, part_type)
    parts = materialize(parts, "bpe-parts").repartition("key", "n").mapInArrow(encode_parts, part_type)
    return short.unionByName(parts.groupBy("key").applyInArrow(join_document, out_type))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of ``encoded`` and the text that its ids decode to (``decoded``)."""
    path = path or tokenizer_path()
    out = fresh(encoded, "decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    at = encoded.columns.index("ids")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            first = 0
            ids = b.column(at)
            while first < len(ids):  # slices with about OUT_BYTES of ids
                last, size, texts = first, 0, []
                while last < len(ids) and size < OUT_BYTES:
                    value = ids[last].as_py() or b""
                    texts.append(c.decode(value))
                    size += len(value)
                    last += 1
                part = b.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out])
                first = last

    return encoded.mapInArrow(decode, f"{fields}, `{out}` string")


def query(spark, sf_dir: str) -> DataFrame:
    decoded = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
