"""Token ids as Arrow files of equal-length sequences.

Documents are put in order of doc_id by ranges, one range a task. A task encodes its
documents, appends the end id to each, and writes their ids as Arrow IPC files: batches of
fixed-size lists, ``ids`` and ``mask`` (true where an id is real). Any sequence of a file is
at a place known beforehand, so a memory map reads it without a copy. The schema's metadata
has the documents of the file and their lengths. A file holds whole documents and about
``FILE_IDS`` ids; its last sequence is padded.

Files are named by range and number and put in place by one rename, so a task that runs
again, after its executor was lost or beside a slow copy, writes the same files.
"""

from __future__ import annotations

import gc
import itertools
import os
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crease.llm.common import freed
from crease.session import shared_folder, staged

#: The tokenizer of the registered query, and the id that ends a document.
TOKENIZER, END = public_tokenizers.path("byte_bpe_50k.json"), 2
#: Ids of a sequence, sequences of a batch, and ids from which on a file is closed.
LENGTH, BATCH, FILE_IDS = 2048, 256, 4_000_000
#: Bytes of a range, about, and pieces whose ids a task remembers.
RANGE_BYTES, REMEMBERED = 48_000_000, 400_000
#: Bytes of texts whose pieces are told apart together, about.
TEXT_BYTES = 4_000_000


#: White space beside a blank or a line end: only the tokenizer itself knows how to cut there.
_UNEVEN = re.compile(r" (?:(?=[^\S ])|(?<=[^\S ] ))|\n(?:(?=\s)|(?<=[^\S\n]\n))")
#: All white space but the blank and the line end; a text without it is cut wherever they stand alone.
_OTHER_SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Signs after a word that are cut off it; an apostrophe is not among them.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters before this one are letters to every version of Unicode that a tokenizer may know.
_LATER = "\u0250"
#: The signs by which a byte-level model knows the bytes that are not printed as they are.
_BYTES = {b: c for c, b in enumerate([*range(33), *range(127, 161), 173], 256)}


class Encoder:
    """Ids of whole texts.

    A byte-level tokenizer always cuts a text before a single blank between two other signs,
    around a single line end between two others, and between letters and the signs after
    them. So such pieces are encoded once each and remembered. Texts with other white space,
    and all texts of other tokenizers, are encoded as they are.
    """

    def __init__(self, path: str, end: int = END):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.small = self.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16
        self.dtype = np.dtype("<u2" if self.small else "<u4")
        self.end = np.array([end], self.dtype).tobytes()
        before = self.tokenizer.pre_tokenizer
        cuts = type(before).__name__ == "ByteLevel" and before.use_regex and not before.add_prefix_space
        self.cuts = cuts and self.tokenizer.normalizer is None
        # Words of letters go to the model itself, unless the tokenizer has words of its own beside it.
        own = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not t.special]
        self.model = self.tokenizer.model if self.cuts and not own else None
        if self.cuts and hasattr(self.tokenizer.model, "_resize_cache"):
            # Pieces are remembered here; the model's own memory of words stays with the process when the encoder is gone.
            self.tokenizer.model._resize_cache(0)
        vocabulary = self.tokenizer.get_vocab(True)
        # Ids of the tokens that begin with a blank, and with a line end.
        self.begins = {sign: np.zeros(max(vocabulary.values()) + 1, bool) for sign in " \n"}
        for token, i in vocabulary.items():
            if token[0] in "\u0120\u010a":
                self.begins[" " if token[0] == "\u0120" else "\n"][i] = True
        # Ids by piece without the blank before it; a piece that begins with a line end has none.
        self.known: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        kind = "H" if self.small else "I"
        for i in range(0, len(texts), 4096):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False):
                ids = array(kind, e.ids)
                if sys.byteorder == "big":
                    ids.byteswap()
                yield ids.tobytes()

    def _plain(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters before ``_LATER``, each after a blank: such a word is one piece to the
        tokenizer, which is left out, and its model gets the word in the signs that stand for its bytes."""
        kind, tokenize = "H" if self.small else "I", self.model.tokenize
        for word in words:
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(_BYTES)
            ids = array(kind, [token.id for token in tokenize("\u0120" + word)])
            if sys.byteorder == "big":
                ids.byteswap()
            yield ids.tobytes()

    def _words(self, words: list[str], sign: str) -> Iterator[bytes]:
        """Ids of words of letters, each after a blank or a line end. They are encoded many at a
        time: a word begins where a token begins with that sign."""
        for i in range(0, len(words), 1000):
            some = words[i : i + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([sign + sign.join(some)], add_special_tokens=False)[0].ids)
            at = (np.flatnonzero(self.begins[sign][ids]) * self.dtype.itemsize).tolist()
            if len(at) != len(some):
                yield from self._encode([sign + w for w in some])
                continue
            data = ids.astype(self.dtype).tobytes()
            yield from [data[a:b] for a, b in zip(at, [*at[1:], len(data)])]

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of pieces, by their letters and signs where they have these alone."""
        known, signs = self.known, self.signs
        plain, made = set(), []
        for piece in pieces:
            letters = piece.rstrip(_SIGNS)
            if len(letters) < len(piece) and letters[letters[:1] == "\n" :].isalpha():
                tail = piece[len(letters) :]
                if tail not in signs:
                    signs[tail] = next(self._encode([tail]))
                if letters not in known:
                    plain.add(letters)
                made.append((piece, letters, tail))
            else:
                plain.add(piece)
        letters = [p for p in plain if p.isalpha()]
        early = [p for p in letters if p.isascii() or max(p) < _LATER] if self.model else []
        known.update(zip(early, self._plain(early)))
        if len(early) < len(letters):
            some = [p for p in letters if p not in known]
            known.update(zip(some, self._words(some, " ")))
        some = [p for p in plain if p[0] == "\n" and p[1:].isalpha()]
        known.update(zip(some, self._words([p[1:] for p in some], "\n")))
        some = [p for p in plain if p not in known]
        known.update(zip(some, self._encode([p if p[0] == "\n" else " " + p for p in some])))
        for piece, letters, tail in made:
            known[piece] = known[letters] + signs[tail]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text and the end id, as little-endian bytes of ``dtype``.

        The pieces of all the texts are told apart first, so that each is looked up once."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.signs.clear()
        if not len(texts):
            return []
        known, texts = self.known, pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        ends = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        numbers, starts, ends = coded.indices.to_numpy(), (ends - ends[0])[:-1], (ends - ends[0])[1:]
        # One string is turned into many of Python's sooner than many of Arrow's.
        once = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")[0].as_py()
        pieces = once.split(" ")
        if self.cuts:
            uneven = pc.is_in(coded.dictionary, pa.array(["", "\n"])).to_numpy(zero_copy_only=False)
            whole = np.logical_or.reduceat(uneven[numbers], starts)
        else:
            whole = np.ones(len(texts), bool)
        if any([c in once for c in _OTHER_SPACES]):
            whole |= [_UNEVEN.search(text) is not None for text in texts.to_pylist()]
        # The first piece of a text has no blank before it, and those of a whole text need not be known.
        used = np.repeat(~whole, ends - starts)
        used[starts] = False
        there = np.zeros(len(pieces), bool)
        there[numbers[used]] = True
        ids = list(map(known.get, pieces))
        gaps = [i for i in np.flatnonzero(there).tolist() if ids[i] is None]
        self._learn([pieces[i] for i in gaps])
        for i in gaps:
            ids[i] = known[pieces[i]]
        direct = [texts[n].as_py() if all_ else pieces[numbers[starts[n]]] for n, all_ in enumerate(whole.tolist())]
        out = []
        for head, all_, start, end in zip(self._encode(direct), whole.tolist(), starts.tolist(), ends.tolist()):
            rest = [] if all_ else map(ids.__getitem__, numbers[start + 1 : end].tolist())
            out.append(b"".join([head, *rest, self.end]))
        return out


def write_file(place: fs.FileSystem, path: str, doc_ids: list[int | None], ids: list[bytes], dtype: np.dtype) -> None:
    """One Arrow file of the documents, in the order given. The metadata has a doc_id for each, 0
    where it is null, and a byte for each that tells whether it is known."""
    flat = np.frombuffer(b"".join(ids), dtype)
    rows = -(-len(flat) // LENGTH)
    padded = np.zeros(rows * LENGTH, dtype)
    padded[: len(flat)] = flat
    mask = np.zeros(rows * LENGTH, bool)
    mask[: len(flat)] = True
    kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    lengths = np.array([len(x) // dtype.itemsize for x in ids], "<i8")
    schema = pa.schema(
        [("ids", pa.list_(kind, LENGTH)), ("mask", pa.list_(pa.bool_(), LENGTH))],
        metadata={
            b"doc_ids": np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
            b"known": bytes(i is not None for i in doc_ids),
            b"lengths": lengths.tobytes(),
        },
    )
    draft = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}.draft"
    with place.open_output_stream(draft) as out, pa.ipc.new_file(out, schema) as writer:
        for i in range(0, rows, BATCH):
            a, b = i * LENGTH, min(rows, i + BATCH) * LENGTH
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x[a:b]), LENGTH) for x in (padded, mask)]
            writer.write_batch(pa.record_batch(lists, schema=schema))
    place.move(draft, path)


def sequence(file: pa.Buffer, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence ``i`` of a file, counted from 0: its ids, without a copy, and its mask.

    ``file`` is a memory map's or any other buffer; the ids are a view of it. Masks are bits
    in the file and are unpacked for the one sequence. An ``i`` outside is an IndexError.
    """
    reader = pa.ipc.open_file(file)
    if i < 0 or i // BATCH >= reader.num_record_batches:
        raise IndexError(i)
    batch = reader.get_batch(i // BATCH)
    if i % BATCH >= batch.num_rows:
        raise IndexError(i)
    ids, mask = (batch.column(name).slice(i % BATCH, 1).flatten() for name in ("ids", "mask"))
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def read_file(content: bytes | pa.Buffer) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """Documents of a file: doc_id or None, ids before it in the file, its ids.

    The ids of all batches are put together once, a copy of at most a file's ids. A file whose
    mask and documents differ is a ValueError.
    """
    reader = pa.ipc.open_file(pa.BufferReader(content) if isinstance(content, bytes) else content)
    batches = [reader.get_batch(i) for i in range(reader.num_record_batches)]
    parts = [b.column("ids").flatten().to_numpy() for b in batches]
    real = sum(int(b.column("mask").flatten().true_count) for b in batches)
    flat = (parts[0] if len(parts) == 1 else np.concatenate(parts)) if parts else np.zeros(0, "<u2")
    meta = reader.schema.metadata
    doc_ids, lengths = np.frombuffer(meta[b"doc_ids"], "<i8"), np.frombuffer(meta[b"lengths"], "<i8")
    if real != lengths.sum():
        raise ValueError("the file's mask and its documents differ")
    starts = np.cumsum(lengths) - lengths
    for doc_id, known, start, n in zip(doc_ids.tolist(), meta[b"known"], starts.tolist(), lengths.tolist()):
        yield doc_id if known else None, start, flat[start : start + n]


def write(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end: int = END) -> DataFrame:
    """Write the documents' ids to ``folder`` in ascending doc_id order; one row for each file.

    Null texts are empty: their ids are the end id alone. Documents without a doc_id stand
    last. Rows with equal ids, or without one, stand in the order of a hash of their texts and
    then of the texts, and may lie in several ranges; repeated rows are written as often as
    they are there. An empty table gives no files. The row: file, part, number, n_docs, n_ids.
    """

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("among"))
    size = rows.agg(F.sum(F.octet_length("text") + 1)).head()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    order = [F.col("doc_id").asc_nulls_last(), "among"]
    ordered = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order, "text")
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freed()
        gc.disable()  # nothing here is cyclic, and there are very many small objects
        try:
            yield from written(batches)
        finally:
            gc.enable()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, end)
        place, root = fs.FileSystem.from_uri(folder)
        place.create_dir(root, recursive=True)
        part, number, held, doc_ids, n = 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"ids-{part:08d}-{number:06d}.arrow"
            write_file(place, f"{root}/{name}", doc_ids, held, encoder.dtype)
            row = {"file": name, "part": part, "number": number, "n_docs": len(held), "n_ids": n}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            part = batch.column(2)[0].as_py() if len(batch) else part
            # A part of the batch at a time, by its bytes, bounds what is held beside it.
            at = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64) // TEXT_BYTES
            for _, same in itertools.groupby(range(len(batch)), at.__getitem__):
                rows = [*same]
                some = batch.slice(rows[0], len(rows))
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1))):
                    held.append(ids)
                    doc_ids.append(doc_id)
                    n += len(ids) // encoder.dtype.itemsize
                    if n >= FILE_IDS:
                        yield flush()
                        number, held, doc_ids, n = number + 1, [], [], 0
        if held:
            yield flush()

    # Storing the list of files is what runs the tasks, once.
    return staged(ordered.mapInArrow(run, "file string, part long, number long, n_docs long, n_ids long"), "files")


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Documents as the files have them: doc_id (null where it was), start, n_tokens, ids_crc32.

    Spark reads the files, each as one value of bounded size, so they may lie wherever it
    can read. ``start`` counts the ids of all documents before; the sums run over one row a file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows = [
                    (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in read_file(content.as_buffer())
                ]
                columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
                file = pa.repeat(path.as_py().rpartition("/")[2], len(rows))
                yield pa.RecordBatch.from_arrays([file, *columns], ["file", "doc_id", "inside", "n_tokens", "ids_crc32"])

    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.arrow").load(folder).select("path", "content")
    found = content.mapInArrow(run, "file string, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(offsets, "file").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END) -> DataFrame:
    """Write all documents to a new folder of the shared place, and read them back from there."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    folder = f"{folder if ':' in folder else f'file://{folder}'}/ids-{uuid.uuid4().hex}"
    files = write(docs, folder, tokenizer, end)
    if files.head() is None:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(spark, folder, files)
