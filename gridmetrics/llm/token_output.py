"""Operator 5: token ids in the Arrow stream-file format.

Documents are tokenised in ascending doc_id order and end with an end id. The
ids of one range of documents run on through sequences of ``SEQUENCE`` ids; a
file is an Arrow IPC file whose record batches hold fixed-size lists: ``ids``
and a ``mask`` (false for the padding after the last id of the file). Equal
length makes sequence k of a batch a plain slice of its buffer, so a reader
that maps the file gets any sequence without copying or parsing. Ids are
unsigned 16-bit where the vocabulary fits, else 32-bit.

Every task writes files under names of its own attempt and returns the manifest
rows of what it has written; only files named in the manifest count, so a task
that is run again after a lost executor, or twice by speculation, does no harm.
Files go to a shared folder through ``pyarrow.fs``. The manifest has one row
per document: file, offset, number of ids; document starts are running totals
over the files.

Defined cases: null text is empty text (only the end id); rows without doc_id
come first; rows with equal doc_id are ordered by a hash of their text;
strings of special tokens in a text are these tokens; an empty table gives no
files and an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, few_texts
from .texthash import chunks, mix64

END_ID = 2
SEQUENCE = 2048
#: Sequences of a record batch, and ids after which a task begins a new file.
BATCH_SEQUENCES = 256
FILE_IDS = 64 << 20
#: Bytes of text handled at once; array work takes about 80 bytes for each.
PART = 512 << 10

MANIFEST = "part int, file_no int, file string, row long, doc_id long, first long, n_tokens long"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


_LETTER_OR_DIGIT = np.zeros(256, bool)
_LETTER_OR_DIGIT[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_ODD = np.zeros(256, bool)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20)]] = True
#: First bytes of characters that are not white space; those of some that are not are left out.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[[*range(0x21, 0x7F), *range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64) -> np.ndarray:
    """The first n powers of the base (of 64-bit integers)."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        x = np.full(max(n, 1 << 16), base, np.uint64)
        x[0] = 1
        have = _POWERS[int(base)] = np.cumprod(x)
    return have[:n]


def irregular(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a row's white space is other than single spaces and line breaks
    between other characters."""
    space = (data == 32) | (data == 10)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    bad = _ODD[data]
    bad[1:] |= space[1:] & (space[:-1] | edge[1:-1])  # two in a row, or at a row's start
    bad[:1] |= space[:1]
    bad |= space & edge[1:]  # at a row's end
    for lead, follows in ((0xC2, ((0x85,), (0xA0,))), (0xE1, ((0x9A, 0x80),)), (0xE3, ((0x80, 0x80),)),
                          (0xE2, ((0x80, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF), (0x81, 0x9F)))):
        at = np.flatnonzero(data == lead)  # white space beyond ASCII
        for second, *third in follows:
            hit = at[data[np.minimum(at + 1, len(data) - 1)] == second]
            if third:
                hit = hit[np.isin(data[np.minimum(hit + 2, len(data) - 1)], third)]
            bad[hit] = True
    at = np.flatnonzero(bad)
    return np.searchsorted(at, offsets[1:]) > np.searchsorted(at, offsets[:-1])


def sections(data: np.ndarray, size: int, visible: np.ndarray = _VISIBLE) -> Iterator[tuple[int, int]]:
    """Bounds of sections of ``size`` bytes and a little more of one text, which
    is cut before a space or line break that a visible character follows."""
    a = 0
    while a < len(data):
        b = len(data)
        for at in range(a + size, len(data) - 1, size):
            part = data[at:at + size + 1]
            hit = np.flatnonzero(((part[:-1] == 32) | (part[:-1] == 10)) & visible[part[1:]])
            if len(hit):
                b = at + int(hit[0])
                break
        yield a, b
        a = b


class Encoder:
    """Texts to ids with the tokenizers library, each word once.

    The byte-level pre-tokenizer never joins characters across a single space
    or line break between two other characters, nor a last comma or stop with
    the letter or digit before it. Rows whose white space is regular are cut
    there, and the ids of a piece are kept by the 64-bit hash of its bytes (until
    there are ``KNOWN`` pieces or ``KNOWN_BYTES`` bytes of them), which are
    compared on every use; other rows, those with the string of an added token
    and those with a piece whose hash another piece has too are encoded whole.
    New pieces go to the library many at a time: a word's first id is the one
    whose token starts with the mark of a space.

    A longer text than ``PART`` bytes is encoded in sections, between which the
    pre-tokenizer cuts as well, so memory does not grow with its length but for
    its ids. Only a text with an added token that takes or holds white space,
    and a stretch without a place to cut, goes to the library as it is.

    The strings of special tokens are these tokens, as the library has it;
    ``special_as_text`` takes them as ordinary text.
    """

    KNOWN = 800_000
    KNOWN_BYTES = 16 << 20
    AT_ONCE = 2000

    def __init__(self, path: str, special_as_text: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if not (special_as_text and t.special)]
        self.added = [t.content.encode() for t in added]
        self.wide = [t.content.encode() for t in added if t.lstrip or t.rstrip or t.content.split() != [t.content]]
        self.visible = _VISIBLE.copy()  # all white space before an added token stays together
        self.visible[[content[0] for content in self.added]] = False
        vocab = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.opens_word = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.opens_word[i] = token.startswith("\u0120")
        self.forget()

    def forget(self) -> None:
        self.keys, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.count, self.ids = np.zeros(0, np.int32), np.zeros(0, self.dtype)
        self.start, self.size, self.bytes = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(x.ids, self.dtype) for k in range(0, len(texts), self.AT_ONCE)
                for x in self.tokenizer.encode_batch_fast(texts[k:k + self.AT_ONCE], add_special_tokens=False)]

    def pieces(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order in which the parts are encoded, number of ids of each in that
        order, their ids one after the other)."""
        after = [i for i, x in enumerate(parts) if x[:1] == b" "]
        bare = [i for i, x in enumerate(parts) if x[:1] != b" "]
        ids = self.whole([parts[i].decode() for i in bare])
        count = [np.array([len(x) for x in ids], np.int64)]
        for k in range(0, len(after), self.AT_ONCE):
            some = [parts[i] for i in after[k:k + self.AT_ONCE]]
            joined = self.whole([b"".join(some).decode()])
            starts = np.flatnonzero(self.opens_word[joined[0]])
            if len(starts) == len(some):
                count.append(np.diff(starts, append=len(joined[0])))
            else:  # a vocabulary of another kind
                joined = self.whole([x.decode() for x in some])
                count.append(np.array([len(x) for x in joined], np.int64))
            ids += joined
        return np.array(bare + after, np.int64), np.concatenate(count), np.concatenate([np.zeros(0, self.dtype), *ids])

    def has_added(self, data: np.ndarray, offsets: np.ndarray, added: list[bytes] | None = None) -> np.ndarray:
        """Whether a row holds the string of an added token (of those given)."""
        out, text = np.zeros(len(offsets) - 1, bool), data.tobytes()
        for content in self.added if added is None else added:
            at = text.find(content)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, "right")) - 1
                out[i] = True
                at = text.find(content, max(int(offsets[i + 1]) - len(content) + 1, at + 1))
        return out

    def learn(self, keys: np.ndarray, parts: list[bytes]) -> None:
        order, count, ids = self.pieces(parts)
        first = len(self.ids) + np.cumsum(count) - count
        size = np.array([len(parts[i]) for i in order.tolist()], np.int64)
        start = len(self.bytes) + np.cumsum(size) - size
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(parts[i] for i in order.tolist()), np.uint8)])
        self.ids = np.concatenate([self.ids, ids])
        keys = np.concatenate([self.keys, keys[order]])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        for name, more in (("first", first), ("count", count), ("start", start), ("size", size)):
            setattr(self, name, np.concatenate([getattr(self, name), more.astype(np.int32)])[order])

    def same(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether pieces are, byte by byte, those kept at ``place``."""
        out = self.size[place] == sizes
        at, n = starts[out], sizes[out]
        before = np.cumsum(n) - n
        inside = np.arange(int(n.sum()))
        differ = data[np.repeat(at - before, n) + inside] != self.bytes[np.repeat(self.start[place[out]] - before, n) + inside]
        out[np.flatnonzero(out)] = np.add.reduceat(differ, before, dtype=np.int64) == 0 if len(n) else True
        return out

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each row."""
        if not len(data):
            return [np.zeros(0, self.dtype)] * (len(offsets) - 1)
        if len(data) > PART:
            return [self.long(data[a:b]) if b - a > PART else self(data[a:b], np.array([0, b - a]))[0]
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        return self.part(data, offsets, irregular(data, offsets) | self.has_added(data, offsets))

    def long(self, data: np.ndarray) -> np.ndarray:
        """Ids of one text that is too long to be handled at once."""
        row = lambda x: np.array([0, len(x)])
        if self.has_added(data, row(data), self.wide).any():
            return self.whole([data.tobytes().decode()])[0]
        out = []
        for a, b in sections(data, PART, self.visible):
            x, inner = data[a:b], data[a + (a > 0):b]  # the space at which it is cut is regular
            if len(x) > 2 * PART:
                out += self.whole([x.tobytes().decode()])
            else:
                out += self.part(x, row(x), irregular(inner, row(inner)) | self.has_added(x, row(x)))
        return np.concatenate(out)

    def part(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> list[np.ndarray]:
        """Ids of each row; ``odd`` ones are not cut."""
        rows = len(offsets) - 1
        if len(self.keys) > self.KNOWN or len(self.bytes) > self.KNOWN_BYTES:
            self.forget()
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        space = (data == 32) | (data == 10)
        stop = ((data == 44) | (data == 46)) & np.append(space[1:], True) | ((data == 44) | (data == 46)) & cut[1:]
        before = np.concatenate([[False], _LETTER_OR_DIGIT[data[:-1]]])
        accent = data[:-2] == 0xC3  # letters of Latin-1 but the two signs
        before[2:] |= accent & (data[1:-1] >= 0x80) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
        cut[:-1] |= space | (stop & before)
        cut[1:] |= data == 10
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(data))
        row = np.searchsorted(offsets, starts, "right") - 1
        use = ~odd[row]
        starts, ends, row = starts[use], ends[use], row[use]
        if len(starts):
            p = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), _BASE), out=p[1:])
            key = mix64((p[ends] - p[starts]) * powers(len(data), _INVERSE)[starts] + (ends - starts).astype(np.uint64))
            kind, at, which = np.unique(key, return_index=True, return_inverse=True)
            place = np.searchsorted(self.keys, kind).clip(max=max(0, len(self.keys) - 1))
            new = self.keys[place] != kind if len(self.keys) else np.ones(len(kind), bool)
            if new.any():
                self.learn(kind[new], [data[a:b].tobytes() for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
                place = np.searchsorted(self.keys, kind)
            place = place[which]
            clash = ~self.same(data, starts, ends - starts, place)
            odd[row[clash]] = True
            n = np.where(clash, 0, self.count[place])
            total = np.cumsum(n, dtype=np.int64)
            flat = self.ids[np.repeat(self.first[place] - (total - n), n) + np.arange(total[-1])]
            bound = np.searchsorted(row, np.arange(rows + 1))
            token = np.concatenate([[0], total])[bound]
        else:
            flat, token = np.zeros(0, self.dtype), np.zeros(rows + 1, np.int64)
        out = [flat[a:b] for a, b in zip(token[:-1].tolist(), token[1:].tolist())]
        strange = np.flatnonzero(odd).tolist()
        texts = [data[offsets[i]:offsets[i + 1]].tobytes().decode() for i in strange]
        for i, ids in zip(strange, self.whole(texts)):
            out[i] = ids
        return out


def open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class SequenceFile:
    """One Arrow file that is being written."""

    def __init__(self, folder: str, dtype: np.dtype, sequence: int):
        self.name = f"ids-{uuid.uuid4().hex}.arrow"
        filesystem, root = open_fs(folder)
        filesystem.create_dir(root, recursive=True)
        self.out = filesystem.open_output_stream(f"{root}/{self.name}")
        self.sequence, self.pending, self.held, self.written = sequence, [], 0, 0
        self.type = pa.from_numpy_dtype(dtype)
        self.writer = pa.ipc.new_file(self.out, file_schema(self.type, sequence))

    def add(self, ids: np.ndarray) -> int:
        """Append ids; returns the place of the first one in the file."""
        first = self.written + self.held
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.sequence * BATCH_SEQUENCES:
            self.flush(False)
        return first

    def flush(self, last: bool) -> None:
        if not self.held:
            return
        ids = np.concatenate(self.pending)
        unit = self.sequence * BATCH_SEQUENCES  # all batches but the last have one size
        full = len(ids) // unit * unit
        whole = -(-len(ids) // self.sequence) * self.sequence if last else full
        block = np.zeros(whole, ids.dtype)
        used = min(whole, len(ids))
        block[:used] = ids[:used]
        for at in range(0, whole, self.sequence * BATCH_SEQUENCES):
            part = block[at:at + self.sequence * BATCH_SEQUENCES]
            mask = np.arange(at, at + len(part)) < len(ids)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (part, mask)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=file_schema(self.type, self.sequence)))
        self.pending = [] if last else [ids[full:]]
        self.written += used
        self.held = 0 if last else len(ids) - full

    def close(self) -> None:
        self.flush(True)
        self.writer.close()
        self.out.close()


def file_schema(kind: pa.DataType, sequence: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("item", kind), sequence)),
                      ("mask", pa.list_(pa.field("item", pa.bool_()), sequence))])


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder for each Python worker: later tasks find its words."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def writer_of(folder: str, vocab: str, end_id: int, sequence: int, file_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, out, file_no, row = None, None, 0, 0
        for batch in batches:
            encoder = encoder or encoder_of(vocab)
            ids, rows = batch.column("doc_id"), []
            for _, _, data, offsets in chunks(batch.column("text"), PART):
                for tokens in encoder(data, offsets):
                    if out is not None and out.written + out.held >= file_ids:
                        out.close()
                        out, file_no = None, file_no + 1
                    out = out or SequenceFile(folder, encoder.dtype, sequence)
                    first = out.add(np.append(tokens, encoder.dtype.type(end_id)))
                    rows.append((file_no, out.name, row, first, len(tokens) + 1))
                    row += 1
            if rows:
                no, name, place, first, n = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.int32()), pa.array(no, pa.int32()), pa.array(name),
                     pa.array(place, pa.int64()), ids, pa.array(first, pa.int64()), pa.array(n, pa.int64())],
                    names=["part", "file_no", "file", "row", "doc_id", "first", "n_tokens"])
        if out is not None:
            out.close()
    return write


class TokenFile:
    """Random access to a written file: ids by place, without reading the rest;
    the place of a batch follows from its number. Local files are memory-mapped;
    elsewhere only the batches asked for are read."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        filesystem, root = open_fs(folder)
        path = f"{root}/{name}"
        self.source = pa.memory_map(path) if isinstance(filesystem, fs.LocalFileSystem) else filesystem.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        sequence = self.reader.schema.field("ids").type.list_size
        self.at: tuple[int, np.ndarray | None] = (-1, None)
        self.size = self.reader.get_batch(0).num_rows * sequence  # of every batch but the last

    def batch(self, k: int) -> np.ndarray:
        if self.at[0] != k:
            self.at = (k, self.reader.get_batch(k).column("ids").values.to_numpy(zero_copy_only=True))
        return self.at[1]

    def ids(self, first: int, n: int) -> np.ndarray:
        out = []
        while n > 0:
            k, at = divmod(first, self.size)
            out.append(self.batch(k)[at:at + n])
            first, n = first + len(out[-1]), n - len(out[-1])
        return out[0] if len(out) == 1 else np.concatenate(out)


def read_back(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, TokenFile] = {}
        for batch in batches:
            crc = []
            for name, first, n in zip(*(batch.column(c).to_pylist() for c in ("file", "first", "n_tokens"))):
                if name not in files:
                    files = {name: TokenFile(folder, name)}  # rows come file by file
                crc.append(zlib.crc32(files[name].ids(first, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(crc, pa.int64())],
                                             names=[*batch.schema.names, "ids_crc32"])
    return read


def write_tokens(docs: DataFrame, folder: str, scratch: Scratch, vocab: str | None = None, end_id: int = END_ID,
                 sequence: int = SEQUENCE, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files and return their manifest (a table)."""
    vocab = vocab or vocabulary()
    ordered = (docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    with few_texts(docs.sparkSession):
        return scratch.save(ordered.mapInArrow(writer_of(folder, vocab, end_id, sequence, file_ids), MANIFEST), "manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32`` from the files."""
    files = manifest.groupBy("part", "file_no").agg(F.sum("n_tokens").alias("file_tokens"))
    before = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "file_no", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("base"))
    # the manifest was written in file order; its splits keep runs of a file together
    back = manifest.mapInArrow(read_back(folder), MANIFEST + ", ids_crc32 long")
    return back.join(files, ["part", "file_no"]).select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, vocab: str | None = None, end_id: int = END_ID, sequence: int = SEQUENCE,
                 file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents as token files and read them back; see the module text."""
    scratch = Scratch(docs.sparkSession, "tokens")
    folder = scratch.path("files")
    return read_tokens(write_tokens(docs, folder, scratch, vocab, end_id, sequence, file_ids), folder)
