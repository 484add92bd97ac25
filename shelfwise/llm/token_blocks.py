"""Token files in patched frame-of-reference blocks.

Documents are dealt to files by ranges of their identifier, so the files in order of their number hold all documents
in ascending order; null identifiers come first. Every task streams its documents through the tokenizer into one
file.

File: magic, blocks, index, footer. A block holds BLOCK ids (the last one of a file fewer): minimum (u32), width (u8),
ids (u16), exceptions (u16); the ids less the minimum, cut to ``width`` bits and packed; places (u16) and high parts
(u32) of the exceptions. The width is the number of bits that PERCENT of the block's ids need. The index holds the
start of every block (u64), then identifier (i64), null mark (u8) and number of ids (u64) of every document; the
footer the counts, the place of the index and a CRC of all before it.

Reading uses the index alone to find blocks, so any range of ids can be read by itself. Positions over all files are
a prefix sum over one row per file.

Tokenizer: the pre-tokenizer cuts before a blank that stands before a visible character, around a single line break and
between a word and the signs behind it, so text between such places can be encoded by itself. Texts of about GROUP_BYTES are
cut as one Arrow column and every distinct piece is looked up once. Each worker remembers the ids of the pieces it met
lately, in about 2 * CACHE_BYTES, and encodes only new ones: a word, which the pre-tokenizer leaves whole, by the
library's model, all else by its whole encoding. Every document ends with END.

Nulls: a null or empty text is the end id alone. Repeated identifiers are documents of their own, ordered by text.
An empty table gives no files and no rows. Only the identifier and the text are read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import release, scratch, text_or_empty
from shelfwise.llm.files import contents, writing

END = 2
BLOCK = 1024
PERCENT = 95
CACHE_BYTES = 40 << 20
PIECE_BYTES = 150  # what a piece takes beside its characters and ids
GROUP_BYTES = 4 << 20
FILE_BYTES = 16 << 20
#: Marks and layouts of the file format.
MAGIC = b"PFORIDS1"
HEAD = "<IBHH"
FOOT = "<QQQQI8s"
FOOT_SIZE = struct.calcsize(FOOT)


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of the ids; all but the last hold BLOCK ids."""
    out = []
    for k in range(0, len(ids), BLOCK):
        part = ids[k : k + BLOCK].astype(np.uint32)
        low = part.min()
        rest = part - low
        width = int(np.partition(rest, rank := (len(rest) - 1) * PERCENT // 100)[rank]).bit_length()
        over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
        bits = (rest[:, None] >> np.arange(width, dtype=np.uint32)).astype(np.uint8) & 1
        out.append(
            struct.pack(HEAD, int(low), width, len(part), len(over))
            + np.packbits(bits.ravel(), bitorder="little").tobytes()
            + over.astype("<u2").tobytes()
            + (rest[over] >> np.uint32(width) if width < 32 else rest[over]).astype("<u4").tobytes()
        )
    return out


def unpack_block(data: memoryview, at: int) -> np.ndarray:
    """Ids of the block that starts at ``at``."""
    low, width, n, n_over = struct.unpack_from(HEAD, data, at)
    at += struct.calcsize(HEAD)
    size = -(-n * width // 8)
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    rest = (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)
    at += size
    place = np.frombuffer(data, "<u2", n_over, at)
    rest[place] |= np.frombuffer(data, "<u4", n_over, at + 2 * n_over) << np.uint32(width)
    return rest + np.uint32(low)


class BlockWriter:
    """Collects documents and writes full blocks as they come."""

    def __init__(self, out):
        self.out, self.crc, self.at = out, 0, 0
        self.starts: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        self.open: list[np.ndarray] = []
        self.n_open = self.n_ids = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.crc = zlib.crc32(data, self.crc)
        self.at += len(data)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.open) if self.open else np.empty(0, np.uint32)
        full = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in pack_blocks(ids[:full]):
            self.starts.append(self.at)
            self._put(block)
        self.open, self.n_open = [ids[full:]], len(ids) - full

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.open.append(ids)
        self.n_open += len(ids)
        self.n_ids += len(ids)
        if self.n_open >= 64 * BLOCK:
            self._flush(False)

    def close(self) -> None:
        self._flush(True)
        index = self.at
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array([d or 0 for d, _ in self.docs], "<i8").tobytes())
        self._put(np.array([d is None for d, _ in self.docs], np.uint8).tobytes())
        self._put(np.array([n for _, n in self.docs], "<u8").tobytes())
        self.out.write(struct.pack(FOOT, self.n_ids, len(self.docs), len(self.starts), index, self.crc, MAGIC))


def read_file(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """(identifier, ids) of every document of a file, in order; raises on a damaged file."""
    n_ids, n_docs, n_blocks, index, crc, magic = struct.unpack_from(FOOT, data, len(data) - FOOT_SIZE)
    if magic != MAGIC or data[: len(MAGIC)] != MAGIC or zlib.crc32(memoryview(data)[: -FOOT_SIZE]) != crc:
        raise ValueError("not a whole token file")
    starts = np.frombuffer(data, "<u8", n_blocks, index)
    at = index + 8 * n_blocks
    names = np.frombuffer(data, "<i8", n_docs, at)
    nulls = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
    sizes = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
    view, held, n_held, block = memoryview(data), [], 0, 0
    for name, null, size in zip(names.tolist(), nulls.tolist(), sizes.tolist()):
        while n_held < size:
            held.append(unpack_block(view, int(starts[block])))
            n_held += len(held[-1])
            block += 1
        whole = np.concatenate(held) if len(held) > 1 else held[0] if held else np.empty(0, np.uint32)
        yield (None if null else name), whole[:size]
        held, n_held = [whole[size:]], len(whole) - size


def byte_letters() -> dict[int, str]:
    """The visible character of every byte in a byte-level vocabulary, as a table for ``str.translate``."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class Encoder:
    """Token ids of texts; parts of texts seen lately are not encoded again.

    Parts live in two generations of about CACHE_BYTES each; when the young one is full it becomes the old one, and what is
    used again moves up. A tokenizer that is not known to cut where this class does gets every text whole.
    """

    cut = re.compile(r"(?= \S)")
    #: Texts with other white space than single blanks and line breaks between words are cut by ``cut``.
    odd = "[" + "".join(f"\\x{{{c:X}}}" for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \n") + "\\x00]|^[ \n]|[ \n]$|[ \n][ \n]|^$"
    word = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
    #: Signs behind a word never go on with it; those here open no contraction and no added token.
    signs = '!"#$%&()*+,-./:;=?@[]^_{}~'
    behind = "([0-9A-Za-zÀ-ÖØ-öø-ÿ])([" + "".join("\\" + c for c in signs) + "])"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = t = Tokenizer.from_file(path)
        first, added = t.pre_tokenizer, t.get_added_tokens_decoder().values()
        self.plain = (
            t.normalizer is None and isinstance(first, pre_tokenizers.ByteLevel) and not first.add_prefix_space and first.use_regex
            and isinstance(t.model, models.BPE) and not t.model.dropout and not t.model.ignore_merges
            and not any(a.lstrip or a.rstrip or a.single_word for a in added)
            and not any(self.word.fullmatch(a.content) or set(a.content) & {*self.signs, " ", "\n"} for a in added)
        )
        self.bytes = byte_letters()
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The texts cut where the pre-tokenizer cuts too: pieces, and where those of every text start and end."""
        if not self.plain:
            at = np.arange(len(texts) + 1)
            return texts, at[:-1], at[1:]
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        even = texts.filter(pa.array(~odd))
        even = pc.replace_substring_regex(even, self.behind, "\\1\0\\2")
        # a single line break between words is a piece of its own
        even = pc.replace_substring(pc.replace_substring(even, "\n", "\0\n\0"), " ", "\0 ")
        lists = pc.split_pattern(even, "\0")
        others = [self.cut.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        pieces = pa.concat_arrays([lists.flatten(), pa.array([p for o in others for p in o], texts.type)])
        sizes = np.empty(len(texts), np.int64)
        sizes[~odd] = pc.list_value_length(lists).to_numpy()
        sizes[odd] = [len(o) for o in others]
        order = np.argsort(odd, kind="stable")
        end = np.empty(len(texts), np.int64)
        end[order] = np.cumsum(sizes[order])
        return pieces, end - sizes, end

    def _learn(self, parts: set[str]) -> None:
        known, old, ids = self.known, self.old, []
        moved = {p: old[p] for p in parts if p in old}
        known.update(moved)
        new = parts.difference(moved)
        words = [p for p in new if self.word.fullmatch(p)] if self.plain else []
        if words:
            # the pre-tokenizer leaves a word whole, so the model can take it at once
            model = self.tokenizer.model.tokenize
            spelled = "\n".join(words).encode().decode("latin-1").translate(self.bytes).split(self.bytes[10])
            ids = [[t.id for t in model(w)] for w in spelled]
        rest = list(new.difference(words))
        ids += [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        raw = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
        ends = np.cumsum([4 * len(part) for part in ids]).tolist()
        known.update({p: raw[i:j] for p, i, j in zip(words + rest, [0, *ends], ends)})
        # characters and ids of a part take about three bytes per character
        self.size += sum(map(len, parts)) * 3 + len(parts) * PIECE_BYTES

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        if self.size > CACHE_BYTES:
            self.known, self.old, self.size = {}, self.known, 0
        new = set(pieces).difference(self.known)
        if new:
            self._learn(new)
        return list(map(self.known.__getitem__, pieces))

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text, with END."""
        pieces, starts, ends = self._pieces(texts.cast(pa.large_string()))
        coded = pieces.dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) // 4
        data = np.frombuffer(ids.buffers()[2] or b"", "<u4", at[-1])
        return [np.append(data[i:j], np.uint32(END)) for i, j in zip(at[starts], at[ends])]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


def groups_of(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], pa.Array]]:
    """Documents of a batch in groups of about GROUP_BYTES, whose new pieces are encoded at once."""
    if not batch.num_rows:
        return
    names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
    before = np.cumsum(pc.binary_length(texts).to_numpy()) // GROUP_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), batch.num_rows]
    for i, j in zip(cuts, cuts[1:]):
        yield names[i:j], texts.slice(i, j - i)


@cache
def encoder_of(path: str) -> Encoder:
    """The encoder of this worker, kept from task to task."""
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files; returns (part, n_docs, n_ids) of the files, and writes when that is read."""
    tokenizer = tokenizer or default_tokenizer()
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = two.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    placed = two.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encoder = encoder_of(tokenizer)
        with writing(folder, f"part-{part:06d}.pfor") as out:
            writer = BlockWriter(out)
            batch = first
            while batch is not None:
                for names, texts in groups_of(batch):
                    for doc_id, ids in zip(names, encoder.encode_all(texts)):
                        writer.add(doc_id, ids)
                batch = next(batches, None)
            writer.close()
        release()
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    return placed.mapInArrow(run, "part long, n_docs long, n_ids long")


def read_tokens(spark, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_of.cache_clear()  # reading needs none
        release()
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                part = int(re.search(r"part-(\d+)\.pfor$", path)[1])
                names, starts, sizes, crcs, at = [], [], [], [], 0
                for name, ids in read_file(data.as_py()):
                    names.append(name)
                    starts.append(at)
                    sizes.append(len(ids))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())],
                    names=["part", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    return contents(spark, folder, "part-*.pfor").mapInArrow(
        run, "part int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )


def token_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the files, read them back: doc_id, start, n_tokens, ids_crc32 of every document."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    files = write_tokens(docs, folder, **options).collect()  # one row per file
    if not files:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    sizes = spark.createDataFrame([(r["part"], r["n_ids"]) for r in files], "part int, n_ids long")
    before = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    rows = read_tokens(spark, folder).join(F.broadcast(offsets), "part")
    return rows.select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
