"""Token ids in flat binary files with 64-bit offsets.

A dataset is a folder of parts. Part `p` has three files: `p.ids`, the ids of its documents one
after another as little-endian unsigned 16- or 32-bit integers; `p.offsets`, one more little-endian
signed 64-bit integer than documents, the place of each document's first id in the part and the
part's end; `p.docs`, per document its id as signed 64-bit integer and a byte that is 1 where the id
is null. Parts hold ascending ranges of `doc_id`. The manifest, a Parquet table, has one row per
part that a task has written to the end: its files, counts and `base`, the number of ids in all parts
before it, a prefix sum over one row per part. Each attempt of a task writes files of its own name, and
only those that Spark commits to the manifest are read, so a lost executor costs a rewritten part.

Local and mounted folders are memory-mapped; other stores are read through pyarrow's file systems.

Defined results: a null or empty text has only the end id; rows of equal `doc_id` stay, ordered by
a checksum of their ids and the ids' bytes; a null `doc_id` comes first; other columns are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import ship, text_or_empty
from stocktide.llm.sketches import batches_of
from stocktide.session import shuffle_width

MANIFEST = "part int, name string, n_docs long, n_ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
CHUNK_ROWS = 2000
#: Texts of about this many bytes are encoded together; cuts, and bytes of cuts and ids, that a generation remembers.
BATCH_BYTES, CACHE_ENTRIES, CACHE_BYTES = 8 << 20, 500_000, 24 << 20
#: First bytes of non-ASCII white space: U+0085 and U+00A0, U+1680, U+2000 to U+205F, U+3000.
SPACE_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)
#: The tokenizers' own byte-level pre-token pattern; files of another pre-tokenizer are refused.
BYTE_LEVEL = "ByteLevel"


class LibraryEncoder:
    """Many texts at once to ids, by the tokenizers library.

    Texts are cut where no pre-token spans: before a space that a character follows, around a line feed between
    two characters, and before a mark that ends a word, so that a word is the same cut whatever mark follows it. Arrow
    finds the distinct cuts of a batch; the library encodes those that aren't remembered, all that start with a
    space in one call; Arrow puts the ids of all cuts one after another. What is remembered ages by generations: a full one
    becomes the older one, and of that only what is met again stays. The cut rule looks at bytes and leaves
    out what might begin a non-ASCII space, so some cuts are longer than they need be. A text that
    spells an added token goes to the library whole, which then does with it what it always does.
    """

    def __init__(self, tokenizer_json: str, end_id: int, width: int = 4):
        import json
        import os

        import numpy as np

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        said = json.loads(tokenizer_json)
        self.tokenizer, self.end_id = Tokenizer.from_str(tokenizer_json), end_id
        self.added = [t["content"].encode() for t in said["added_tokens"]]
        vocabulary = said["model"]["vocab"]
        #: A character of a byte-level token stands for a byte.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, "i8")
        self.bytes_of[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.follows = np.zeros(256, bool)
        self.follows[0x21:] = True
        self.follows[list(SPACE_LEADS)] = False
        #: ASCII letters and digits; ASCII marks but the apostrophe, which opens a pre-token with letters.
        self.word = np.array([chr(b).isalnum() and b < 0x80 for b in range(256)])
        self.mark = np.array([0x21 <= b < 0x7F and chr(b) != "'" for b in range(256)]) & ~self.word
        self.ids_type = np.dtype(f"<u{width}")
        self.end = np.array([end_id], self.ids_type).tobytes()
        self.known, self.older, self.held = {}, {}, 0

    def _remember(self, cuts: list[bytes], flat: bytes, sizes) -> None:
        """Keep the ids of cuts; `flat` has them one after another."""
        import numpy as np

        ends = (np.cumsum(sizes) * self.ids_type.itemsize).tolist()
        self.known.update(zip(cuts, [flat[a:b] for a, b in zip([0, *ends], ends)]))
        self.held += sum(map(len, cuts)) + len(flat)

    def _ids_of(self, cuts: list[bytes]) -> list[bytes]:
        """Ids of distinct cuts, from memory or from the library."""
        if len(self.known) > CACHE_ENTRIES or self.held > CACHE_BYTES:
            self.known, self.older, self.held = {}, self.known, 0
        missing = [c for c in cuts if c not in self.known]
        if missing:
            again = [c for c in missing if c in self.older]
            if again:
                flat = [self.older[c] for c in again]
                self.known.update(zip(again, flat))
                self.held += sum(map(len, again)) + sum(map(len, flat))
                missing = [c for c in missing if c not in self.older]
            self._learn(missing)
        return list(map(self.known.__getitem__, cuts))

    def _whole(self, texts: list[str]) -> list[list[int]]:
        # The fast form leaves out the places of tokens, which nobody reads here.
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, cuts: list[bytes]) -> None:
        """Encode cuts: those that a space and a character open make up a text in which they are the cuts again."""
        import numpy as np

        opened = [c for c in cuts if len(c) > 1 and c[0] == 0x20 and self.follows[c[1]]]
        if opened:
            ids = np.array(self._whole([b"".join(opened).decode()])[0], "u4")
            ends = np.cumsum(self.bytes_of[ids])
            want = np.cumsum([len(c) for c in opened])
            last = np.searchsorted(ends, want)
            if not (ends[last] == want).all():
                raise ValueError("a token spans two cuts")
            self._remember(opened, ids.astype(self.ids_type).tobytes(), np.diff(last + 1, prepend=0))
        others = [c for c in cuts if not (len(c) > 1 and c[0] == 0x20 and self.follows[c[1]])]
        if others:
            found = self._whole([c.decode() for c in others])
            self._remember(others, np.array([i for f in found for i in f], self.ids_type).tobytes(), [len(f) for f in found])

    def _ends_word(self, data):
        """Which bytes end a letter or digit of ASCII, or a letter from U+00C0 to U+017F."""
        import numpy as np

        ends = self.word[data]
        wide = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5)) + 1
        lead, trail = data[wide - 1], data[wide]
        ends[wide[(lead != 0xC3) | ((trail != 0x97) & (trail != 0xB7))]] = True  # but the times and division signs
        return ends

    def _cuts(self, data, starts):
        """Where cuts begin in texts that lie one after another from `starts`."""
        import numpy as np

        begins = np.zeros(len(data) + 1, bool)
        begins[starts] = True
        if len(data) > 1:
            next_ok = np.append(self.follows[data[1:]] & ~begins[1:-1], False)
            begins[:-1] |= (data == 0x20) & next_ok
            lines = np.flatnonzero((data[1:] == 0x0A) & (data[:-1] > 0x20) & (data[:-1] < 0x80) & next_ok[1:]) + 1
            begins[lines] = True
            begins[lines + 1] = True
            # Marks inside of words, as in file names, part no cuts: those would hardly repeat.
            inside = self.word[data[1:]] | (data[1:] >= 0x80)
            marks = np.flatnonzero(self.mark[data[1:]] & self._ends_word(data)[:-1] & ~np.append(inside[1:], False)) + 1
            begins[marks] = True
        return np.flatnonzero(begins[:-1])

    def __call__(self, texts: list[bytes]):
        """Ids of all texts one after another, each with the end id, and how many each text has."""
        import numpy as np
        import pyarrow as pa

        odd = {i: t for i, t in enumerate(texts) if any(a in t for a in self.added)}
        plain = [b"" if i in odd else t for i, t in enumerate(texts)] if odd else texts
        lengths = np.array([len(t) for t in plain], "i8")
        joined = b"".join(plain)
        data, starts = np.frombuffer(joined, "u1"), np.cumsum(lengths) - lengths
        begins = self._cuts(data, starts)
        offsets = np.append(begins, len(data)).astype("i4")
        coded = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
        known = self._ids_of(_slices(coded.dictionary))
        # The end id is one more entry, put behind the last cut of each text.
        upto = np.searchsorted(begins, starts + lengths)
        index = np.insert(coded.indices.to_numpy(), upto, len(known))
        made = pa.array([*known, self.end], pa.binary()).take(pa.array(index))
        _, ends, flat = made.buffers()
        ends = np.frombuffer(ends, "i4")[upto + np.arange(len(texts)) + 1].astype("i8") // self.ids_type.itemsize
        ids, counts = np.frombuffer(flat, self.ids_type)[: ends[-1] if len(ends) else 0], np.diff(ends, prepend=0)
        if odd:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, found in zip(odd, self._whole([t.decode() for t in odd.values()])):
                parts[i] = np.array([*found, self.end_id], self.ids_type)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, counts


def _slices(values) -> list[bytes]:
    """The values of an Arrow binary array."""
    import numpy as np

    _, ends, data = values.buffers()
    if not len(values) or data is None:
        return [b""] * len(values)
    whole, ends = data.to_pybytes(), np.frombuffer(ends, "i4")[values.offset : values.offset + len(values) + 1].tolist()
    return [whole[a:b] for a, b in zip(ends, ends[1:])]


def _ranges(documents: DataFrame, n: int):
    """The largest id of each of `n` ranges of about as many rows, and how many of the ranges are for null ids.

    The largest ids come from a sketch of the ids alone; an id of many rows fills several ranges.
    """
    doc = F.col("doc_id").cast("long")
    shares = F.percentile_approx(doc, [i / n for i in range(1, n + 1)], 20 * n)
    found = documents.agg(shares.alias("c"), F.max(doc).alias("m"), F.count_if(doc.isNull()).alias("nulls"), F.count("*").alias("n")).first()
    nulls = math.ceil(n * found["nulls"] / found["n"]) if found["n"] else 0
    return [*(found["c"] or [])[:-1], *([] if found["m"] is None else [found["m"]])], nulls


def _encode(shared, width: int):
    """`part`, `doc_id`, `tie` and `ids` of every document; parts hold ascending ranges of (`doc_id`, `tie`)."""

    def parts_of(ids, ties, heads, nulls):
        import numpy as np

        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        share = ties / float(1 << 32)
        first = np.searchsorted(heads, known, "left") if len(heads) else np.zeros(len(known), "i8")
        last = np.maximum(first, np.searchsorted(heads, known, "right") - 1)
        spread = nulls + first + (share * (last - first + 1)).astype("i8")
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), (share * nulls).astype("i8"), spread)

    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        given = shared.value  # plain values; the encoder stays beside them while the worker lives
        if "encoder" not in given:
            given["encoder"] = LibraryEncoder(given["json"], given["end_id"], width)
        encode = given["encoder"]
        for batch in batches:
            for first, texts in batches_of(batch.column(1), BATCH_BYTES):
                found, counts = encode(texts)
                flat = found.tobytes()
                ends = np.concatenate(([0], np.cumsum(counts))) * width
                rows = [flat[a:b] for a, b in zip(ends, ends[1:])]
                ids, ties = batch.column(0).slice(first, len(texts)), np.array([zlib.crc32(r) for r in rows], "i8")
                parts = parts_of(ids, ties, np.array(given["heads"], "i8"), given["nulls"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), ids, pa.array(ties), pa.array(rows, pa.binary())], names=["part", "doc_id", "tie", "ids"]
                )

    return run


def _store(folder: str):
    """File system and path of a folder given as a path or URI."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _write_part(folder: str, width: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
        store, n_docs, n_ids, out = None, 0, 0, []
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if store is None:
                store, path = _store(folder)
                store.create_dir(path, recursive=True)
                out = [store.open_output_stream(f"{path}/{name}.{kind}") for kind in ("ids", "offsets", "docs")]
            docs = np.zeros(batch.num_rows, [("id", "<i8"), ("null", "u1")])
            docs["null"] = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            docs["id"] = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            starts = []
            for ids in batch.column(1):
                data = ids.as_buffer()
                out[0].write(data)
                starts.append(n_ids)
                n_ids += data.size // width
            out[1].write(np.array(starts, "<i8").tobytes())
            out[2].write(docs.tobytes())
            n_docs += batch.num_rows
        if store is not None:
            out[1].write(np.array([n_ids], "<i8").tobytes())
            for stream in out:
                stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((part, name, n_docs, n_ids), schema)], schema=schema)

    return run


def write_dataset(documents: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encode all documents into `folder` and return the manifest, ordered parts with their `base`.

    The tokenizer file is read once on the driver and broadcast as text; its size doesn't depend on the data.
    Texts are encoded where they are read, and only their ids are shuffled, once, to ranges of `doc_id`.
    """
    import json

    with open(tokenizer_path, encoding="utf-8") as file:
        source = file.read()
    said = json.loads(source)
    if said["pre_tokenizer"]["type"] != BYTE_LEVEL or said["pre_tokenizer"].get("add_prefix_space") or said.get("normalizer"):
        raise ValueError("only plain byte-level vocabularies can be encoded by the piece")
    highest = max([end_id, *said["model"]["vocab"].values(), *[t["id"] for t in said["added_tokens"]]])
    width = 4 if highest > 0xFFFF else 2
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    n = shuffle_width(spark)
    heads, nulls = _ranges(texts, n)
    shared = spark.sparkContext.broadcast({"json": source, "end_id": end_id, "heads": heads, "nulls": nulls})
    folder = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    encoded = texts.mapInArrow(_encode(shared, width), "part int, doc_id long, tie long, ids binary")
    placed = encoded.repartitionById(n + nulls, "part").select("doc_id", "tie", "ids")
    sorted_ = placed.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "ids").select("doc_id", "ids")
    sorted_.mapInArrow(_write_part(f"{folder}/parts", width), MANIFEST).write.parquet(f"{folder}/manifest")
    # One row per part: as many as the shuffle has partitions, whatever the data's size.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select(
        "part", F.concat(F.lit(f"{folder}/parts/"), "name").alias("path"), "n_docs", "n_ids",
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("base"),
        F.lit(width).alias("width"),
    )


class Part:
    """One part, opened for reading; ids and offsets are mapped, not loaded, where the store allows."""

    def __init__(self, path: str, width: int):
        import numpy as np

        store, local = _store(path)
        if store.type_name == "local":
            load = lambda kind, dtype: np.memmap(f"{local}.{kind}", dtype, "r")
        else:
            load = lambda kind, dtype: np.frombuffer(store.open_input_file(f"{local}.{kind}").readall(), dtype)
        self.offsets, self.ids = load("offsets", "<i8"), load("ids", f"<u{width}")
        self.docs = load("docs", np.dtype([("id", "<i8"), ("null", "u1")]))

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, i: int):
        """Ids of the part's i-th document."""
        return self.ids[self.offsets[i] : self.offsets[i + 1]]


def _read_parts(batches: Iterator) -> Iterator:
    import zlib

    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            part = Part(row["path"], row["width"])
            if len(part) != row["n_docs"] or int(part.offsets[-1]) != row["n_ids"] or len(part.ids) != row["n_ids"]:
                raise ValueError(f"{row['path']} doesn't hold what the manifest says")
            for at in range(0, len(part), CHUNK_ROWS):
                to = min(at + CHUNK_ROWS, len(part))
                docs, offsets = part.docs[at:to], np.asarray(part.offsets[at : to + 1])
                sums = [zlib.crc32(part[i].astype("<u4").tobytes()) for i in range(at, to)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(docs["id"]), mask=np.asarray(docs["null"]) == 1), pa.array(offsets[:-1] + row["base"]), pa.array(np.diff(offsets)), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def read_dataset(manifest: DataFrame) -> DataFrame:
    """Per document its place in the whole dataset, its number of ids and their CRC-32, from the files."""
    # A number keeps adaptive execution from merging tasks by the size of the manifest's own rows.
    rows = manifest.repartitionByRange(shuffle_width(manifest.sparkSession), "part")
    return rows.mapInArrow(_read_parts, READ)


ship(__name__)
