"""Line dedup that can be undone: exact reference counts, and sharded cuckoo filters in front of them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.common import map_bytes, packed, plain, stored, text_of, unpacked

BLANK_BYTES = b" \t\n\x0b\f\r"
HOT = 4096


class Cuckoo:
    """Cuckoo filter of 16-bit fingerprints, four to a bucket. Keys are 16-byte digests.

    It is backed by exact counts, so a key is inserted once and only keys that were inserted are deleted. An insertion
    that finds no place answers False; the caller then builds a filter of twice the size from the exact counts.
    """

    SLOTS, KICKS = 4, 500

    def __init__(self, buckets: int, table: bytes | None = None):
        self.mask = buckets - 1
        self.table = np.frombuffer(table, "<u2").copy() if table else np.zeros(buckets * self.SLOTS, "<u2")

    @classmethod
    def for_keys(cls, n: int) -> "Cuckoo":
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, n) / (0.8 * cls.SLOTS))))))

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:2], "little") or 1
        at = int.from_bytes(key[2:10], "little") & self.mask
        return mark, at, self._other(at, mark)

    def _other(self, at: int, mark: int) -> int:
        return (at ^ (mark * 0x5BD1E995)) & self.mask

    def add(self, key: bytes) -> bool:
        mark, one, two = self._places(key)
        for at in (one, two):
            row = self.table[at * self.SLOTS:(at + 1) * self.SLOTS]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = mark
                return True
        at = one
        for turn in range(self.KICKS):
            slot = at * self.SLOTS + (turn + mark) % self.SLOTS
            mark, self.table[slot] = int(self.table[slot]), mark
            at = self._other(at, mark)
            row = self.table[at * self.SLOTS:(at + 1) * self.SLOTS]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = mark
                return True
        return False

    def remove(self, key: bytes) -> bool:
        mark, one, two = self._places(key)
        for at in (one, two):
            found = np.flatnonzero(self.table[at * self.SLOTS:(at + 1) * self.SLOTS] == mark)
            if len(found):
                self.table[at * self.SLOTS + found[0]] = 0
                return True
        return False

    def __contains__(self, key: bytes) -> bool:
        mark, one, two = self._places(key)
        return any((self.table[at * self.SLOTS:(at + 1) * self.SLOTS] == mark).any() for at in (one, two))


def line_key(line: bytes) -> bytes:
    """Blanks stripped at both ends, A-Z lower-cased (both concern ASCII bytes only)."""
    return line.strip(BLANK_BYTES).lower()


def _line_rows(docs: DataFrame, min_points: int) -> DataFrame:
    """(doc_id, version, pos, key) of all lines whose key has ``min_points`` code points; key: 128-bit digest."""
    def run(batches):
        for b in batches:
            out = {"doc_id": [], "version": [], "pos": [], "key": []}
            for doc_id, version, text in zip(b["doc_id"], b["version"], b["text"]):
                for pos, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if len(key) >= min_points and len(key.decode("utf-8", "replace")) >= min_points:
                        out["doc_id"].append(doc_id)
                        out["version"].append(version)
                        out["pos"].append(pos)
                        out["key"].append(hashlib.md5(key, usedforsecurity=False).digest())
            yield out

    return map_bytes(_versioned(docs), run, "doc_id bigint, version bigint, pos int, key binary")


def _versioned(docs: DataFrame) -> DataFrame:
    """Rows that repeat an id with another text differ in ``version``; rows that repeat both are treated alike."""
    return plain(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("version"), "text")


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")


@dataclass(frozen=True)
class LineIndex:
    """State of the dedup: which documents hold which long line, how many, and filters over the repeated lines.

    ``postings`` (key, doc_id) are the exact references, ``counts`` (key, n_docs, keep) their numbers and largest ids,
    ``filters`` (shard, table) one cuckoo filter per shard over keys with at least ``min_docs`` documents. Every
    operation returns a new state in shared storage; the old one stays valid.
    """

    spark: SparkSession
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    min_docs: int = 5
    min_points: int = 40
    shards: int = 64

    @classmethod
    def empty(cls, spark: SparkSession, min_docs: int = 5, min_points: int = 40, shards: int = 64) -> "LineIndex":
        nothing = lambda schema: spark.createDataFrame([], schema)
        return cls(spark, nothing("key binary, doc_id bigint"), nothing("key binary, n_docs bigint, keep bigint"),
                   nothing("shard int, table binary"), min_docs, min_points, shards)

    def _same(self, a: DataFrame, b: DataFrame) -> Column:
        return (a["key"] == b["key"]) & a["doc_id"].eqNullSafe(b["doc_id"])

    def insert(self, docs: DataFrame) -> "LineIndex":
        """Add documents. A document that is known already adds the lines it did not have."""
        return self._insert(_line_rows(docs, self.min_points))

    def _insert(self, lines: DataFrame) -> "LineIndex":
        found = lines.select("key", "doc_id").distinct()
        found = stored(found.join(self.postings, self._same(found, self.postings), "left_anti"), "lines-new")
        more = found.groupBy("key").agg(F.count(F.lit(1)).alias("more"), F.max("doc_id").alias("top"))
        joined = self.counts.join(more, "key", "full")
        counts = stored(joined.select(
            "key", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"),
            F.greatest("keep", "top").alias("keep"), F.coalesce("n_docs", F.lit(0)).alias("before")), "lines-counts")
        return self._next(self.postings.unionByName(found), counts)

    def delete(self, doc_ids: DataFrame) -> "LineIndex":
        """Forget documents (a table with doc_id): the state is the one without them ever having been inserted."""
        gone = doc_ids.select(F.col("doc_id").alias("_id")).distinct()
        marked = self.postings.join(gone, self.postings["doc_id"].eqNullSafe(gone["_id"]), "left_semi")
        lost = stored(marked, "lines-lost")
        left = stored(self.postings.join(gone, self.postings["doc_id"].eqNullSafe(gone["_id"]), "left_anti"), "lines-left")
        less = lost.groupBy("key").agg(F.count(F.lit(1)).alias("less"), F.max("doc_id").alias("top"))
        # the largest id is looked up again only for keys that lost theirs
        tops = left.join(lost.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("again"))
        joined = self.counts.join(less, "key", "left").join(tops, "key", "left")
        counts = stored(joined.select(
            "key", (F.col("n_docs") - F.coalesce("less", F.lit(0))).alias("n_docs"),
            F.when(F.col("less").isNull() | (F.col("keep") > F.col("top")), F.col("keep")).otherwise(F.col("again")).alias("keep"),
            F.col("n_docs").alias("before")), "lines-counts")
        return self._next(left, counts)

    def _next(self, postings: DataFrame, counts: DataFrame) -> "LineIndex":
        """Bring the filters up to date: only keys that cross ``min_docs`` enter or leave."""
        now, before = F.col("n_docs") >= self.min_docs, F.col("before") >= self.min_docs
        repeated = counts.where(now).groupBy(_shard(self.shards).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
        # a row per shard: its filter so far and how many keys it must hold now
        heads = self.filters.join(repeated, "shard", "full").select(
            "shard", F.lit(0).alias("kind"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "table", F.lit(None).cast("binary").alias("key"))
        change = F.when(now & ~before, F.lit(2)).when(~now & before, F.lit(1))
        kept = F.when(now & before, F.lit(3))
        moves = counts.select(_shard(self.shards).alias("shard"), F.coalesce(change, kept).alias("kind"), F.lit(None).cast("bigint").alias("n"),
                              F.lit(None).cast("binary").alias("table"), "key").where("kind is not null")
        stream = heads.unionByName(moves).repartition(self.shards, "shard").sortWithinPartitions("shard", "kind", "key")
        filters = stored(map_bytes(stream, _update_filters, "shard int, table binary", ("table", "key")), "lines-filters")
        counts = counts.where("n_docs > 0").select("key", "n_docs", "keep")
        return replace(self, postings=postings, counts=counts, filters=filters)

    def repeated(self, lines: DataFrame) -> DataFrame:
        """(key, n_docs, keep) of the keys in ``lines`` that are repeated. The filters answer first; only keys they do
        not exclude meet the exact counts."""
        asked = lines.select("key").distinct().select(
            _shard(self.shards).alias("shard"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("table"), "key")
        heads = self.filters.select("shard", F.lit(0).alias("kind"), "table", F.lit(None).cast("binary").alias("key"))
        stream = heads.unionByName(asked).repartition(self.shards, "shard").sortWithinPartitions("shard", "kind")
        likely = map_bytes(stream, _probe_filters, "key binary", ("table", "key"))
        return self.counts.where(F.col("n_docs") >= self.min_docs).join(likely, "key", "left_semi")

    def clean(self, docs: DataFrame, lines: DataFrame | None = None) -> DataFrame:
        """``docs`` with columns ``kept_text``, ``n_lines``, ``n_dropped``: repeated lines stay in their largest document."""
        lines = stored(_line_rows(docs, self.min_points), "lines-rows") if lines is None else lines
        flagged = stored(self.repeated(lines), "lines-flagged")
        # at most 4,096 keys can hold a 4,096th of the references each; they are matched through a broadcast
        total = self.counts.agg(F.sum("n_docs")).first()[0] or 0
        is_hot = F.col("n_docs") * HOT >= F.lit(total)
        hot = flagged.where(is_hot).select(F.col("key").alias("hot_key"), F.col("keep").alias("hot_keep"))
        cold = flagged.where(~is_hot).select("key", "keep")
        tagged = lines.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left")
        of_hot = tagged.where("hot_key is not null").select("doc_id", "version", "pos", F.col("hot_keep").alias("keep"))
        of_cold = tagged.where("hot_key is null").select("doc_id", "version", "pos", "key").join(cold, "key").drop("key")
        drops = of_hot.unionByName(of_cold).where(~F.col("doc_id").eqNullSafe(F.col("keep")))
        drops = drops.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("drops"))
        drops = drops.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("drops").alias("_drops"))
        rows = packed(docs, "doc_id", "text").withColumn("_v", F.xxhash64("text"))
        joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_v") == F.col("_version")), "left")
        return _without_lines(joined.drop("_v", "_id", "_version"), docs.columns)


def _update_filters(batches):
    """Per shard: its filter (kind 0), then keys to remove (1), to add (2) and those that stay (3)."""
    shard, filt, fresh, n = None, None, False, 0
    keys: list[bytes] = []  # of a shard whose filter is built anew; bounded like the filter itself

    def done():
        f = filt
        if fresh:
            size = max(1, n)
            while True:
                f = Cuckoo.for_keys(size)
                if all([f.add(k) for k in keys]):
                    break
                size *= 2
        return {"shard": [shard], "table": [f.table.tobytes()]}

    for b in batches:
        for s, kind, count, table, key in zip(b["shard"], b["kind"], b["n"], b["table"], b["key"]):
            if s != shard:
                if shard is not None:
                    yield done()
                shard, keys, n = s, [], count or 0
                old = Cuckoo(len(table) // 2 // Cuckoo.SLOTS, table) if table else None
                # built anew when there is none or it would be too full
                fresh = old is None or n > 0.9 * len(old.table)
                filt = old
            if kind == 0:
                continue
            if kind >= 2:
                keys.append(key)
            if not fresh and kind == 1:
                filt.remove(key)
            if not fresh and kind == 2 and not filt.add(key):
                fresh = True
    if shard is not None:
        yield done()


def _probe_filters(batches):
    """Per shard: its filter (kind 0), then the keys asked for; yields those it does not exclude."""
    shard, filt = None, None
    for b in batches:
        out = []
        for s, kind, table, key in zip(b["shard"], b["kind"], b["table"], b["key"]):
            if s != shard:
                shard, filt = s, None
            if kind == 0:
                filt = Cuckoo(len(table) // 2 // Cuckoo.SLOTS, table)
            elif filt is not None and key in filt:
                out.append(key)
        yield {"key": out}


def _without_lines(joined: DataFrame, columns: list[str]) -> DataFrame:
    """Rebuild the texts that lose lines; the others pass unchanged in the JVM. Linear in the number of lines. The three
    columns that are added replace those of the same name."""
    lines = F.split(text_of(), "\n", -1)
    # positions that stay, by a set difference, then the lines at them
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_drops")
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    out = joined.withColumn("kept_text", F.when(F.col("_drops").isNull(), text_of()).otherwise(kept))
    dropped = F.when(F.col("_drops").isNull(), F.lit(0)).otherwise(F.size("_drops"))
    columns = [c for c in columns if c not in ("kept_text", "n_lines", "n_dropped")]
    return out.select(*unpacked(columns, ("doc_id", "text")), "kept_text", F.size(lines).cast("bigint").alias("n_lines"), dropped.cast("bigint").alias("n_dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_points: int = 40, shards: int = 64) -> DataFrame:
    """``docs`` (doc_id bigint, text) with ``kept_text``, ``n_lines`` and ``n_dropped``: all documents are inserted into
    an empty index, then cleaned against it.

    Null or empty text: one empty line. Null id: one more document, smaller than all others. Rows that repeat an id
    count as one document; with different texts, a line that stays in one of them stays in all. Lines shorter than
    ``min_points`` code points always stay. Of several documents with a line, the largest id keeps it, wherever and as often
    as it stands there. Texts of any length are split in the task that reads them. Columns that are named like the three
    added ones are replaced, all others stay. Empty table: no rows.
    """
    spark = docs.sparkSession
    lines = stored(_line_rows(docs, min_points), "lines-rows")
    index = LineIndex.empty(spark, min_docs, min_points, shards)._insert(lines)
    return index.clean(docs, lines)
