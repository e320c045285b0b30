"""Consolidation of very many tiny files into few well-sized ones.

The store keeps records under ``data/kind=../part=../v=..`` and one JSON document per committed version under
``_snapshots``, which names the folders that are live in each bucket. A run reads the newest version, finds the
buckets that hold more small files than allowed, rewrites only those, appends what came for the others as one small
file each, and only then commits the next version, which names what it wrote. Data and snapshots never change once
written: a run that dies before its commit leaves nothing that a reader sees, and a reader of an older version
still finds all of its files. The commit creates its document exclusively: if another writer has committed
meanwhile, it fails with ``CommitConflict``, and what was written for it is deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.session import through_disk

RECORD = ("kind", "stem", "item")
#: Payload columns of both record kinds; a kind leaves the other's columns null.
PAYLOAD = (
    ("read_order", "bigint"),
    ("class", "string"),
    ("prompt", "string"),
    ("run_id", "int"),
    ("crops", "bigint"),
    ("layout_s", "double"),
    ("recognize_s", "double"),
    ("assemble_s", "double"),
)


class CommitConflict(RuntimeError):
    """Another writer committed a version after this run had read its own."""


def bare_name(c: Column) -> Column:
    """Lower case, without outer blanks and leading directories (either slash)."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(c, r"^(?s).*[/\\]", ""), r"^\s+|\s+$", "")))


def bare_stem(c: Column) -> Column:
    """``bare_name`` without an image suffix."""
    return F.regexp_replace(bare_name(c), r"\.(png|jpg)$", "")


def as_records(manifest: DataFrame, timing: DataFrame) -> DataFrame:
    """Both record tables in one shape, keyed by (kind, stem, item).

    Rows whose page, or whose crop or run, is null have no identity and are left out.
    """

    def shape(df: DataFrame, kind: str, item: Column) -> DataFrame:
        have = set(df.columns)
        return df.select(
            F.lit(kind).alias("kind"),
            bare_stem(F.col("stem")).alias("stem"),
            item.alias("item"),
            F.col("file_id").cast("bigint").alias("file_id"),
            F.col("row_no").cast("int").alias("row_no"),
            *[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in PAYLOAD],
        )

    both = shape(manifest, "manifest", bare_name(F.col("crop"))).unionByName(shape(timing, "timing", F.col("run_id").cast("string")))
    return both.where(F.col("stem").isNotNull() & F.col("item").isNotNull())


def deduplicate(records: DataFrame) -> DataFrame:
    """One row per record; of copies, the one from the file written last wins (ties: higher file_id, row_no).

    The aggregate combines on the map side, so a page that holds a third of all rows costs no more than others.
    """
    rest = [c for c in records.columns if c not in (*RECORD, "part")]
    keys = [c for c in (*RECORD, "part") if c in records.columns]
    rank = F.struct(F.coalesce(F.col("written_at").cast("timestamp_ntz"), F.lit("1970-01-01").cast("timestamp_ntz")), F.coalesce("file_id", F.lit(-1)), F.coalesce("row_no", F.lit(-1)))
    best = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("r"))
    return best.select(*keys, *[F.col("r")[c].alias(c) for c in rest])


@dataclass
class Snapshot:
    """A committed version: for each bucket ``kind/part`` its live folders, as (v, bytes)."""

    version: int = 0
    n_parts: int = 0
    live: dict[str, list[tuple[str, int]]] = field(default_factory=dict)

    @property
    def bytes(self) -> int:
        return sum(n for folders in self.live.values() for _, n in folders)


COLUMNS = "kind string, stem string, item string, file_id bigint, row_no int, " + ", ".join(f"`{n}` {t}" for n, t in PAYLOAD) + ", written_at timestamp_ntz, part int, v string"


class CompactStore:
    """A versioned, bucketed record store on any Hadoop file system.

    ``target_bytes`` is the size of a bucket to aim at, ``small_files`` how many small files it may hold beside its
    large one before it is rewritten, ``file_bytes`` what a listed file counts whose size is not known.
    """

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, small_files: int = 1, file_bytes: int = 1000):
        self.spark, self.root, self.target_bytes, self.small_files, self.file_bytes = spark, root.rstrip("/"), target_bytes, small_files, file_bytes

    def _path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._path("_snapshots")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or the one asked for; an empty one where nothing has been committed."""
        version = version or max(self.versions(), default=0)
        if not version:
            return Snapshot()
        fs, p = self._path(f"_snapshots/{version:08d}.json")
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Snapshot(**json.loads(text))

    def _commit(self, snap: Snapshot) -> None:
        fs, p = self._path(f"_snapshots/{snap.version:08d}.json")
        try:
            out = fs.create(p, False)
        except Exception as e:  # Py4J wraps FileAlreadyExists
            raise CommitConflict(f"version {snap.version} exists already") from e
        out.write(bytearray(json.dumps(snap.__dict__).encode()))
        out.close()

    def _at(self, snap: Snapshot, buckets: Iterable[str]) -> DataFrame:
        """The stored records of some buckets."""
        paths = []
        for k in buckets:
            kind, part = k.split("/")
            paths += [f"{self.root}/data/kind={kind}/part={part}/v={v}" for v, _ in snap.live.get(k, ())]
        reader = self.spark.read.schema(COLUMNS)
        return reader.option("basePath", f"{self.root}/data").parquet(*paths) if paths else self.spark.createDataFrame([], COLUMNS)

    def read(self, version: int | None = None) -> DataFrame:
        """Every record once, as of a version; only buckets with appended small files can hold one twice."""
        snap = self.snapshot(version)
        several = [k for k, folders in snap.live.items() if len(folders) > 1]
        whole = self._at(snap, [k for k in snap.live if k not in several])
        return (whole.unionByName(deduplicate(self._at(snap, several))) if several else whole).drop("v")

    def compact(self, records: DataFrame, files: DataFrame) -> Snapshot:
        """Take in the records of the listed tiny files and rewrite the buckets that hold too many small ones.

        ``records`` as from ``as_records``, or with the ``written_at`` of their files, which are then not joined; ``files``
        has ``file_id`` and ``written_at`` and may have ``size_bytes``. A
        bucket is a hash of the record key, so a page with very many records spreads over all of them; their
        number follows from the bytes stored and listed, and doubles when those outgrow it, which rewrites all. A
        bucket of the store whose small files, those appended before and the new ones, are at most ``small_files`` is
        not rewritten: its new records are appended as one small file. Jobs run when this is called.
        """
        start = self.snapshot()
        size = F.coalesce(F.col("size_bytes").cast("bigint"), F.lit(self.file_bytes)) if "size_bytes" in files.columns else F.lit(self.file_bytes)
        listed = files.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
        want = max(1, -(-(start.bytes + listed) // self.target_bytes))
        n = start.n_parts or want
        while want >= 2 * n:
            n *= 2
        when = F.col("written_at").cast("timestamp_ntz")
        dated = records if "written_at" in records.columns else records.join(files.select("file_id", when.alias("written_at")), "file_id", "left")
        part = F.pmod(F.xxhash64(*RECORD), F.lit(n)).cast("int").alias("part")
        placed = through_disk(dated.select(*[c for c in dated.columns if c != "part"], part), "arrivals")  # read twice, cleaned up once
        counts = placed.groupBy("kind", "part").agg(F.countDistinct(F.coalesce("file_id", F.lit(-1))).alias("n")).collect()  # n buckets of two kinds
        waiting = {f"{r['kind']}/{r['part']}": r["n"] for r in counts}
        if start.version and n != start.n_parts:
            due, later = sorted({*waiting, *start.live}), []
        else:
            due = [k for k, v in waiting.items() if k not in start.live or v + len(start.live[k]) - 1 > self.small_files]
            later = [k for k in waiting if k not in due]
        v = f"{start.version + 1:08d}-{uuid.uuid4().hex[:12]}"
        incoming = placed
        if due and start.version:
            stored = self._at(start, due).select(*[c for c in placed.columns if c != "part"], part)
            incoming = placed.unionByName(stored)
        if waiting or due:
            whole = deduplicate(incoming).withColumn("v", F.lit(v))
            # one file a bucket, as all its rows are in one task; a retry of the write replaces its own folders only
            whole.repartition(max(1, 2 * n), "kind", "part").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("kind", "part", "v").parquet(f"{self.root}/data")
        written = {f"{kind}/{k}": n_bytes for kind, k, n_bytes in self._sizes(v)}
        live = {} if n != start.n_parts else {k: [tuple(x) for x in f] for k, f in start.live.items() if k not in due}
        for k, n_bytes in written.items():
            live.setdefault(k, []).append((v, n_bytes))
        snap = Snapshot(start.version + 1, n, live)
        try:
            if self.snapshot().version != start.version:
                raise CommitConflict(f"version {start.version} is no longer the newest")
            self._commit(snap)
        except CommitConflict:
            self._drop({(k, v) for k in written})
            raise
        return snap

    def _sizes(self, v: str) -> Iterator[tuple[str, int, int]]:
        """(kind, part, bytes) of the folders of one write."""
        fs, p = self._path(f"data/kind=*/part=*/v={v}/*.parquet")
        total: dict[tuple[str, int], int] = {}
        for s in fs.globStatus(p) or ():
            at = s.getPath().getParent().getParent()
            k = (at.getParent().getName().split("=")[1], int(at.getName().split("=")[1]))
            total[k] = total.get(k, 0) + s.getLen()
        return ((kind, part, n) for (kind, part), n in sorted(total.items()))

    def _drop(self, folders: set[tuple[str, str]]) -> None:
        for k, v in folders:
            kind, part = k.split("/")
            fs, p = self._path(f"data/kind={kind}/part={part}/v={v}")
            fs.delete(p, True)

    def expire(self, keep: int = 2) -> int:
        """Delete all but the newest versions and the folders that only they name; returns how many folders went."""
        versions = self.versions()
        folders = lambda vs: {(k, f[0]) for x in vs for k, fs in self.snapshot(x).live.items() for f in fs}
        gone = folders(versions[:-keep]) - folders(versions[-keep:])
        for x in versions[:-keep]:
            fs, p = self._path(f"_snapshots/{x:08d}.json")
            fs.delete(p, False)
        self._drop(gone)
        return len(gone)
