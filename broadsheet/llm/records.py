"""Token ids in binary files: length-delimited records with masked checksums, and an offset index beside each file."""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.common import map_bytes, new_path, plain, stored

# File format (fixed): length u64, masked crc of the length, payload, masked crc of the payload; little-endian.
# Payload: id i64, 1 if it has an id u8, bytes per token u8, tokens. Index: offset u64 and payload length u64 a record.
HEAD, CRC, DOC, SLOT = "<Q", "<I", "<qBB", "<QQ"
HEAD_SIZE, CRC_SIZE, DOC_SIZE = struct.calcsize(HEAD), struct.calcsize(CRC), struct.calcsize(DOC)


def masked_crc(data: bytes) -> int:
    """crc32, rotated and shifted, so that a checksum over data that holds checksums stays good."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(HEAD, len(payload))
    return b"".join((length, struct.pack(CRC, masked_crc(length)), payload, struct.pack(CRC, masked_crc(payload))))


def unframe(stream, where: str) -> bytes | None:
    """The next payload of a stream, None at its end; damage raises."""
    length = stream.read(HEAD_SIZE)
    if not length:
        return None
    check = stream.read(CRC_SIZE)
    if len(length) < HEAD_SIZE or len(check) < CRC_SIZE or struct.unpack(CRC, check)[0] != masked_crc(length):
        raise ValueError(f"{where}: damaged length")
    n = struct.unpack(HEAD, length)[0]
    payload, check = stream.read(n), stream.read(CRC_SIZE)
    if len(payload) < n or len(check) < CRC_SIZE or struct.unpack(CRC, check)[0] != masked_crc(payload):
        raise ValueError(f"{where}: damaged record")
    return payload


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(DOC, doc_id or 0, doc_id is not None, width) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, has_id, width = struct.unpack_from(DOC, payload)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", offset=DOC_SIZE)


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class RecordFile:
    """Reads single records of a file in any order through its index."""

    def __init__(self, path: str):
        files, at = _files(path)
        self.index = np.frombuffer(files.open_input_stream(f"{at}.idx").read(), "<u8").reshape(-1, 2)
        self.path, self.file = path, files.open_input_file(f"{at}.rec")

    def __len__(self) -> int:
        return len(self.index)

    def __getitem__(self, i: int) -> tuple[int | None, np.ndarray]:
        self.file.seek(int(self.index[i, 0]))
        return unpack(unframe(self.file, self.path))


# a space followed by more white space: there, words cannot be encoded one by one
TROUBLE = re.compile(rb" (?:[\s\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a|\xe2[\x80\x81]|\xe3\x80)")


class PerWorker:
    """A broadcast of this gives every Python worker one encoder that its tasks share; it is made on first use."""

    def __init__(self, path: str):
        self.path, self.made = path, None

    def get(self) -> "WordEncoder":
        if self.made is None:
            self.made = WordEncoder(self.path)
        return self.made


class WordEncoder:
    """The ids of whole texts, from the ids of their words.

    The tokenizer's pattern never joins a word to what stands before the single space in front of it, so a text's ids
    are those of its words, each with its space. Every distinct word of a few megabytes of text is encoded once and
    frequent ones stay known; a text with runs of white space or added tokens is encoded as a whole. ``limit`` bounds the words kept.
    """

    def __init__(self, path: str, limit: int = 800_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # texts with the string of an added token go whole, since it may stand anywhere in a word
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.whole = re.compile(b"|".join([TROUBLE.pattern, *map(re.escape, added)]))
        self.width = 2 if self.tokenizer.get_vocab_size() <= 65_536 else 4
        # bytes of each token; a byte-level vocabulary spells each byte with one character
        self.sizes = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(token)
        self.known: dict[bytes, bytes] = {}
        self.limit = limit

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in found]

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words with a space before each: many are encoded as one text, whose ids' bytes show where words end."""
        out = []
        for k in range(0, len(words), 500):
            part = words[k:k + 500]
            text = b" " + b" ".join(part)
            # without offsets, which would cost a third more
            found = self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids
            ids = np.array(found, f"<u{self.width}")
            ends, want = np.cumsum(self.sizes[ids]), np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            cuts = np.searchsorted(ends, want) + 1
            if not len(ends) or ends[-1] != len(text) or (ends[cuts - 1] != want).any():
                out += self._encoded([" " + w.decode("utf-8", "replace") for w in part])
                continue
            packed, cuts = ids.tobytes(), np.r_[0, cuts] * self.width
            out += [packed[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if t.endswith(b" ") or self.whole.search(t)]
        out = dict(zip(whole, self._encoded([texts[i].decode("utf-8", "replace") for i in whole])))
        split = [i for i in range(len(texts)) if i not in out]
        out.update(zip(split, self._of_words([texts[i] for i in split]) if split else ()))
        return [out[i] for i in range(len(texts))]

    def _of_words(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts that are encoded word by word; Arrow numbers the words and puts their ids in order."""
        words = pc.split_pattern(pa.array(texts, pa.large_binary()), pattern=" ")
        flat = words.flatten().dictionary_encode()
        here, at, starts = flat.dictionary.to_pylist(), flat.indices.to_numpy().copy(), words.offsets.to_numpy()
        heads: dict[bytes, int] = {}  # no other word holds a space, so one marks those without
        at[starts[:-1]] = [heads.setdefault(b" " + here[i], len(here) + len(heads)) for i in at[starts[:-1]].tolist()]
        here += heads
        known = self.known
        new = [w for w in here if w not in known]
        first = [w for w in new if w[:1] == b" "]
        known.update(zip(first, self._encoded([w[1:].decode("utf-8", "replace") for w in first])))
        inner = [w for w in new if w[:1] != b" "]
        known.update(zip(inner, self._word_ids(inner)))
        found = pa.array([known[w] for w in here], pa.large_binary()).take(pa.array(at))
        _, ends, data = found.buffers()
        cuts = np.frombuffer(ends, np.int64)[starts].tolist()
        packed = data.to_pybytes() if data else b""
        out = [packed[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        if len(known) > self.limit:  # this portion's words are likely to come again
            self.known = {w: known[w] for w in here} if len(here) < self.limit // 2 else {}
        return out


def portions(texts: list[bytes], size: int = 4 << 20):
    """Slices of a list of texts with about ``size`` bytes each; a longer text stands alone."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield slice(at, i)
            at, total = i, 0
        total += len(t)
    if at < len(texts):
        yield slice(at, len(texts))


def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0) -> DataFrame:
    """Encode ``docs`` (doc_id bigint, text) and write them in ascending order of doc_id; returns the list of files.

    Ranges of ids are dealt to tasks by the session's shuffle partitions; a task encodes and writes its range as one
    file. The name holds the attempt, and only names of finished tasks enter the list (part, file, n_docs, n_tokens),
    which is written to ``folder`` too: a task that is run again leaves nothing wrong behind. Null text: only the end
    id. Null ids come first; rows that repeat an id follow one another. Empty table: no files.
    """
    shared = docs.sparkSession.sparkContext.broadcast(PerWorker(tokenizer))

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        encoder, rec, idx = None, None, None
        at = n_docs = n_tokens = 0
        for b in batches:
            for part in portions(b["text"]):
                if rec is None:
                    encoder = shared.value.get()
                    files, base = _files(folder)
                    rec, idx = files.open_output_stream(f"{base}/{name}.rec"), files.open_output_stream(f"{base}/{name}.idx")
                end = end_id.to_bytes(encoder.width, "little")
                for doc_id, ids in zip(b["doc_id"][part], encoder.encode(b["text"][part])):
                    record = frame(pack(doc_id, ids + end, encoder.width))
                    rec.write(record)
                    idx.write(struct.pack(SLOT, at, len(record) - HEAD_SIZE - 2 * CRC_SIZE))
                    at, n_docs, n_tokens = at + len(record), n_docs + 1, n_tokens + len(ids) // encoder.width + 1
        if rec is not None:
            rec.close()
            idx.close()
            yield {"part": [task.partitionId()], "file": [name], "n_docs": [n_docs], "n_tokens": [n_tokens]}

    _make(docs.sparkSession, folder)
    rows = plain(docs, "doc_id", "text").withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return stored(map_bytes(rows, run, "part int, file string, n_docs bigint, n_tokens bigint"), path=f"{folder}/files")


def _make(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file) of every record, read from the files with all checksums tested.

    A task reads one file as a stream. What precedes a file is known from the list of files, of which only a row per
    file reaches the driver.
    """
    listed = spark.read.parquet(f"{folder}/files").orderBy("part").collect()
    starts, total = [], 0
    for r in listed:
        starts.append((r["part"], r["file"], total))
        total += r["n_tokens"]

    def run(batches):
        files, base = _files(folder)
        for b in batches:
            for name, start in zip(b["file"], b["start"]):
                out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": [], "file": []}
                with files.open_input_stream(f"{base}/{name}.rec", buffer_size=1 << 20) as stream:
                    while (payload := unframe(stream, name)) is not None:
                        doc_id, ids = unpack(payload)
                        for key, value in zip(out, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), name)):
                            out[key].append(value)
                        start += len(ids)
                        if len(out["doc_id"]) == 5000:
                            yield out
                            out = {k: [] for k in out}
                yield out

    table = spark.createDataFrame(starts, "part int, file string, start bigint")
    table = table.repartitionByRange(max(1, len(starts)), "part")
    return map_bytes(table, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, file string", ())


def token_records(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0) -> DataFrame:
    """Write ``docs`` as records under ``folder`` (default: a new one in shared storage) and read them back."""
    folder = folder or new_path(docs.sparkSession, "records")
    write_records(docs, tokenizer, folder, end_id)
    return read_records(docs.sparkSession, folder)
