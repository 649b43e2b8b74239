"""Token ids as flat binary files with 64-bit document offsets.

Documents are dealt out by ranges of their id and encoded in ascending order. Each task writes

* ``part-<range>-<attempt>.ids``: all token ids of the range, flat little-endian unsigned integers
  (16 bits where the vocabulary fits, else 32);
* ``part-<range>-<attempt>.idx``: little-endian 64-bit ``offsets`` (documents + 1, relative to the
  file);
* ``part-<range>-<attempt>.names``: the document ids, of whatever type, as an Arrow file.

and returns one manifest row. Only files named in the manifest count, so files left by a lost or
repeated attempt are never read. The base of a file, where its ids stand among all ids, is the prefix
sum of the counts in the manifest. Reading maps the files into memory where the folder is a mounted
one; other stores hand out the bytes of a file as a buffer.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.common import arrow_map, slices, split, stage
from filigree.session import fresh_path

END = 2
REMEMBERED_BYTES = 32 << 20  # what remembered stretches may take in a worker, at ``EACH`` bytes besides their own
EACH = 160
READ_AT_ONCE = 1 << 16
ENCODE_AT_ONCE = 4 << 20  # bytes of text
# Without ' and >, which can belong to 's and <|endoftext|>, and without U+0130, whose lower case ends in a mark.
ENDING = r"([0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([!-&(-/:-=?@\[-`{-~]+)(\s|$)"
MANIFEST = "part int, ids_path string, idx_path string, names_path string, width int, n_docs long, n_ids long"


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` one after another."""
    stops = np.cumsum(sizes)
    return values[np.repeat(starts - (stops - sizes), sizes) + np.arange(int(sizes.sum()))]


class Encoder:
    """The library's encoding, with the ids of blank-separated stretches remembered.

    The vocabulary's own splitting drops white space, so no token spans it; each stretch is encoded
    by the library as it stands.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.library = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)  # for a-z alone, which normalising leaves as they are
        self.plain.normalizer = normalizers.Sequence([])
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.bytes = 0
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def learn(self, fresh: list[str]) -> dict[str, int]:
        """Add new stretches, words of a-z first, then other words of letters, and return their places."""
        kinds: tuple[list[str], ...] = ([], [], [])
        for w in fresh:
            kinds[0 if (letters := w.isalpha()) and w.isascii() and w.islower() else 1 if letters else 2].append(w)
        ordered = [w for kind in kinds for w in kind]
        found = [self.ask_letters(kinds[0], self.plain), self.ask_letters(kinds[1], self.library), self.ask(kinds[2])]
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        places = dict(zip(ordered, range(len(self.sizes), len(self.sizes) + len(ordered)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])
        return places

    def ask(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of all words, and the number of ids of each."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        found = self.library.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))

    def ask_letters(self, words: list[str], library) -> tuple[np.ndarray, np.ndarray]:
        """A word of letters is one unit of the vocabulary's splitting, so all go in as one text whose word-end ids part them."""
        if not words:
            return self.ask(words)
        ids = np.array(library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        sizes = np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)
        if len(sizes) != len(words):  # lower-casing can turn a letter into a letter and a mark
            return self.ask(words)
        return ids, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by ``END``, and the number of ids of each.

        Splitting, lower-casing and numbering of the stretches are Arrow's; Python sees each
        distinct stretch of ``texts`` once. ASCII symbols that end a stretch after a digit or Latin letter
        are a token run of their own, so they are split off (``ENDING``). What does not fit into ``REMEMBERED_BYTES`` any more
        is forgotten again.
        """
        texts = pc.fill_null(texts, "")
        lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))  # special strings keep their case
        words, counts = split(pc.replace_substring_regex(lowered, ENDING, r"\1 \2\3"))
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        n_known, n_ids = len(self.sizes), len(self.ids)
        places = np.fromiter((self.place.get(w, -1) for w in distinct), np.int64, len(distinct))
        missing = np.flatnonzero(places < 0)
        fresh = [distinct[k] for k in missing.tolist()]
        if fresh:
            new = self.learn(fresh)
            places[missing] = np.fromiter(map(new.__getitem__, fresh), np.int64, len(fresh))
        at = places[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[at]
        flat = ragged(self.ids, self.starts[at], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        room = self.bytes + sum(map(len, fresh)) + EACH * len(fresh)
        if fresh and room <= REMEMBERED_BYTES:
            self.place.update(new)
            self.bytes = room
        elif fresh:
            self.ids, self.starts, self.sizes = self.ids[:n_ids], self.starts[:n_known], self.sizes[:n_known]
        return np.insert(flat, ends, END), np.diff(ends, prepend=0) + 1


_encoders: dict[str, Encoder] = {}


def write_token_files(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files below ``folder`` and return the manifest, one row for each file.

    ``path`` is the vocabulary file, present on every executor. Null counts as an empty text, which
    has the end id only. Documents without an id come last; rows that repeat an id, or have none, stand
    next to each other, in the order of their texts. An empty table writes no file. Other columns are not read. The manifest is a table in the shared folder.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        part = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        stem = f"{root}/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        counts, ids, total, out = [], [], 0, None
        for batch in slices(batches, ENCODE_AT_ONCE):
            if out is None:
                store.create_dir(root)
                out = store.open_output_stream(f"{stem}.ids")
            flat, sizes = encoder.encode(batch.column("t"))
            out.write(flat.astype(f"<u{encoder.width}").tobytes())
            counts.append(sizes)
            ids.append(batch.column("i"))
            total += len(flat)
        if out is None:
            return
        out.close()
        sizes, names = np.concatenate(counts), pa.table({"i": pa.chunked_array(ids)})
        with store.open_output_stream(f"{stem}.idx") as index:
            index.write(np.concatenate([[0], np.cumsum(sizes)]).astype("<u8").tobytes())
        with store.open_output_stream(f"{stem}.names") as sink, pa.ipc.new_file(sink, names.schema) as writer:
            writer.write_table(names)
        row = {"part": part, "ids_path": f"{stem}.ids", "idx_path": f"{stem}.idx", "names_path": f"{stem}.names", "width": encoder.width, "n_docs": len(sizes), "n_ids": total}
        kinds = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

    own = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    last = F.col("i").asc_nulls_last()
    dealt = own.repartitionByRange(last).sortWithinPartitions(last, "t")
    return stage(arrow_map(dealt, run, MANIFEST))


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``, the number of ids in the files before; one row for each file."""
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).cast("long"))


def open_part(folder: str, ids_path: str, idx_path: str, names_path: str, width: int) -> tuple[np.ndarray, np.ndarray, pa.ChunkedArray]:
    """Ids, offsets and document ids of one file."""
    store, _ = fs.FileSystem.from_uri(folder)
    if isinstance(store, fs.LocalFileSystem):
        load = lambda p, kind: np.memmap(p, kind, "r") if os.path.getsize(p) else np.zeros(0, kind)
    else:
        load = lambda p, kind: np.frombuffer(store.open_input_file(p).read(), kind)
    with store.open_input_file(names_path) as source:
        names = pa.ipc.open_file(source).read_all().column("i")
    return load(ids_path, f"<u{width}"), load(idx_path, "<u8"), names


def read_token_files(manifest: DataFrame, folder: str, id_col: str = "doc_id", id_type: str = "long") -> DataFrame:
    """``(id_col, start, n_tokens, ids_crc32)`` of every document, from the files.

    ``start`` counts the ids of all documents before, ``ids_crc32`` is the unsigned CRC-32 of the
    document's ids as little-endian 32-bit integers. ``id_type`` is the type the ids were written with.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, names = open_part(folder, row["ids_path"], row["idx_path"], row["names_path"], row["width"])
                cuts = offsets.astype(np.int64)
                for start in range(0, len(names), READ_AT_ONCE):
                    own = cuts[start : start + READ_AT_ONCE + 1]
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)]
                    columns = [names[start : start + READ_AT_ONCE].combine_chunks(), pa.array(own[:-1] + row["base"]), pa.array(np.diff(own)), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["i", "start", "n_tokens", "ids_crc32"])

    files = with_bases(manifest)
    spread = files.repartition(max(1, manifest.count()), "part")
    read = arrow_map(spread, run, f"i {id_type}, start long, n_tokens long, ids_crc32 long")
    return read.withColumnRenamed("i", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files into the shared folder and return what reading them back gives."""
    folder = fresh_path(docs.sparkSession, "tokens")
    folder = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    return read_token_files(write_token_files(docs, path, folder, id_col, text_col), folder, id_col, docs.select(id_col).schema[0].dataType.simpleString())
