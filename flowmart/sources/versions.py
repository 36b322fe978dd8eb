"""Partitioned tables whose loads become visible as a whole.

A load writes its rows below a folder of its own and never touches a folder a reader may
have open. Which folders make up the table stands in a numbered manifest, a small Parquet
table that is put in place by one rename. So a reader sees the state of one commit, a load
that breaks off leaves the table as it was, and of two loads at once the later one finds its
number taken and starts anew from what the other one made.

    path/data/load=<id>/<partition>=<value>/*.parquet    rows of one load
    path/index/load=<id>/*.parquet                       Bloom filters of that load's keys
    path/commits/<number>/*.parquet                      folders of the table, one row each

The manifest names each folder's commit, so a consumer that keeps the last commit it took
gets all later rows once, whatever their times. It also has the range of the folder's keys;
with that and the Bloom filter a load decides which folders may hold its keys, and reads the
key columns of these only.

The file system must refuse to rename onto an existing folder, as HDFS and local ones do.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from flowmart.operators.incremental import NULL_PARTITION, write_partitioned
from flowmart.session import Scratch, discard

#: Bits and probes of a Bloom filter per key: one key in about 15,000 passes by chance.
BITS_PER_KEY, PROBES = 20, 7
#: Keys of a load up to which Spark may choose a broadcast. It judges by the compressed file,
#: where millions of keys can take a few MB; as a hash table on the driver they take gigabytes.
FEW_KEYS = 100_000
#: Attempts of a load whose commit number others take.
ATTEMPTS = 20
#: Manifests that stay for readers that have begun.
COMMITS_KEPT = 20


class CommitTaken(RuntimeError):
    """Another load was committed in the meantime."""


class CompactedAway(ValueError):
    """The commits a consumer asks for were merged with earlier ones."""


def _filter_bits(keys: int) -> int:
    """Size of a Bloom filter: a power of two."""
    return max(32, 1 << (BITS_PER_KEY * keys - 1).bit_length())


def _probes(bits: Column) -> Column:
    """Places of `key` in a filter of so many bits."""
    return F.array(*[F.pmod(F.xxhash64("key", F.lit(i)), bits) for i in range(PROBES)])


# The signs Spark escapes in the name of a partition's folder, besides control characters.
_ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


def _escaped(name: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in name)


def _folder() -> Column:
    """Partition folder of a row below its load's folder."""
    plain = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(plain, r"/load=[^/]+/([^/]+)/", 1)


class VersionedTable:
    """A table at `path`, partitioned by one column, with rows told apart by `keys`."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), partition: str = "day"):
        self.spark, self.path, self.partition, self.keys = spark, path.rstrip("/"), partition, list(keys)

    # --- reading ---------------------------------------------------------------

    def commit(self) -> int:
        """Number of the newest commit, 0 before the first."""
        return max((int(name) for name, _ in self._listed("commits") if name.isdigit()), default=0)

    def entries(self, commit: int | None = None) -> list[Row]:
        """Folders of the table at a commit, the newest one if none is given."""
        number = self.commit() if commit is None else commit
        # A row per folder, which any Spark read of the table keeps on the driver too.
        return self.spark.read.parquet(f"{self.path}/commits/{number}").collect() if number else []

    def read(self, commit: int | None = None) -> DataFrame | None:
        """Rows at a commit, or None where there are none."""
        return self._rows(self.entries(commit))

    def newest(self) -> DataFrame | None:
        """Rows of the highest partition."""
        entries = self._dated(self.entries())
        return self._rows([e for e in entries if e.folder == entries[0].folder])

    def newest_of_each(self, column: str, values: Sequence[str]) -> DataFrame | None:
        """The newest partitions that together hold every listed `column` value."""
        missing, taken, entries = set(values), [], self._dated(self.entries())
        for folder in dict.fromkeys(e.folder for e in entries):
            here = [e for e in entries if e.folder == folder]
            wanted = self._rows(here).where(F.col(column).isin(*missing))
            # At most one row per listed value.
            found = {row[0] for row in wanted.select(column).distinct().collect()}
            taken += here if found else []
            missing -= found
            if not missing:
                break
        return self._rows(taken)

    def changes(self, since: int, upto: int | None = None) -> DataFrame | None:
        """Rows put in by commits after `since`, up to `upto`; replaced rows in their new form."""
        late = [e for e in self.entries(upto) if e.commit > since]
        if any(e.since <= since for e in late):
            raise CompactedAway(f"{self.path}: commits up to {max(e.commit for e in late)} are one now")
        return self._rows(late)

    def taken(self) -> int:
        """The last commit of its source this table has taken up."""
        return max((e.taken for e in self.entries()), default=0)

    def _dated(self, entries: list[Row]) -> list[Row]:
        dated = [e for e in entries if not e.folder.endswith(f"={NULL_PARTITION}")]
        return sorted(dated, key=lambda e: e.folder, reverse=True)

    def _rows(self, entries: Sequence[Row], located: bool = False) -> DataFrame | None:
        entries = [e for e in entries if e.load]
        if not entries:
            return None
        paths = [f"{self.path}/data/load={e.load}/{e.folder}" for e in entries]
        rows = self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths)
        return rows if located else rows.drop("load")

    # --- writing ---------------------------------------------------------------

    def replace(self, new: DataFrame, taken: int = 0) -> int:
        """Put rows in; stored rows of the same key go (I2). Returns the commit.

        A key must not change its partition value: one that is stored under another
        value fails the load. Folders without a row of the load's keys stay as they
        are. `taken` records the commit of the source that the rows come from.
        """
        with Scratch(self.spark) as scratch:
            new = scratch.pin(new, "load")
            return self._attempted(lambda entries: self._replaced(entries, new, taken))

    def add_partitions(self, rows: DataFrame, names: Sequence[str]) -> int:
        """Add whole partitions, each once: those that are there by then are left out.

        `names` are all partition values of the load; one without rows is recorded too.
        Returns the commit, 0 if nothing was left to add.
        """
        wanted = {f"{self.partition}={_escaped(name)}" for name in names}
        left: list[Row] = []

        def added(entries: list[Row]) -> list[Row] | None:
            present = {e.folder for e in entries}
            every = made + [self._nothing(folder) for folder in wanted - {e.folder for e in made}]
            left[:] = [e for e in every if e.folder not in present]
            return entries + left if left else None

        made = self._written(rows, 0)
        commit = self._attempted(added)
        return commit if left else 0

    def _nothing(self, folder: str) -> Row:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        return Row(load="", folder=folder, taken=0, since=0, commit=0, rows=0, bits=0, low=None, high=None, loaded_at=now)

    def overwrite(self, rows: DataFrame, taken: int = 0) -> int:
        """Reload the whole table; all of it counts as changed. Returns the commit."""
        with Scratch(self.spark) as scratch:
            rows = scratch.pin(rows, "load")
            return self._attempted(lambda entries: self._written(rows, taken))

    def compact(self, folders: int = 1, upto: int | None = None) -> int:
        """Merge partitions of more than `folders` folders, bin-packed into few files.

        Only rows of commits up to `upto` are merged (all, if not given): consumers
        that have taken that commit are not concerned, others get `CompactedAway`.
        Returns the commit, the present one where there is nothing to do.
        """

        def merged(entries: list[Row]) -> list[Row] | None:
            old = [e for e in entries if upto is None or e.commit <= upto]
            by_folder = {name: [e for e in old if e.folder == name] for name in dict.fromkeys(e.folder for e in old)}
            many = [e for part in by_folder.values() if len(part) > folders for e in part]
            if not many:
                return None
            bounds = (min(e.since for e in many), max(e.commit for e in many))
            made = self._written(self._rows(many), max(e.taken for e in many), bounds)
            return [e for e in entries if e not in many] + made

        return self._attempted(merged)

    def vacuum(self, hours: float = 24.0) -> int:
        """Remove old manifests, and loads of no kept manifest that are older than `hours`.

        Returns the number of loads removed. The age spares loads still being written.
        """
        numbers = sorted((int(n) for n, _ in self._listed("commits") if n.isdigit()), reverse=True)
        kept = {e.load for n in numbers[:COMMITS_KEPT] for e in self.entries(n)}
        before = self.spark._jvm.java.lang.System.currentTimeMillis() - hours * 3_600_000
        old = [name for name, at in self._listed("data") if at < before and name.removeprefix("load=") not in kept]
        discard(self.spark, *[f"{self.path}/commits/{n}" for n in numbers[COMMITS_KEPT:]])
        discard(self.spark, *[f"{self.path}/{part}/{name}" for name in old for part in ("index", "data")])
        return len(old)

    def _attempted(self, make) -> int:
        """Commit what `make` turns the present folders into; anew if another load came first."""
        for _ in range(ATTEMPTS):
            present = self.commit()
            entries = make(self.entries(present))
            if entries is None:
                return present
            try:
                return self._commit(present + 1, entries)
            except CommitTaken:
                continue
        raise CommitTaken(f"{self.path}: {ATTEMPTS} commits were taken by others")

    def _commit(self, number: int, entries: list[Row]) -> int:
        schema = self._schema(entries)
        stamp = {"since": number, "commit": number}
        stamped = [e.asDict() if e.commit else e.asDict() | stamp for e in entries]
        rows = [tuple(e[name] for name in schema.names) for e in stamped]
        temporary = f"{self.path}/commits/_new-{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(temporary)
        files, source = self._located(temporary)
        target = files.makeQualified(self._located(f"{self.path}/commits/{number}")[1])
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(source), target, none)
        except Py4JJavaError as error:
            discard(self.spark, temporary)
            if files.exists(target):
                raise CommitTaken(f"{self.path}: commit {number}") from error
            raise
        return number

    def _replaced(self, entries: list[Row], new: DataFrame, taken: int) -> list[Row] | None:
        made = self._written(new, taken)
        if not made:  # no rows, no commit
            return None
        if not entries or not self.keys:
            return entries + made
        if sum(e.rows for e in made) > FEW_KEYS:
            new = new.hint("merge")
        touched = {e.folder for e in made}
        known = new.select(*self.keys)
        clashes = self._holding(self._candidates(entries, made, known), known)
        moved = [e for e in clashes if e.folder not in touched]
        if moved:
            example = self._rows(moved).join(known, self.keys, "left_semi").select(*self.keys).first()
            raise ValueError(f"{self.path}: {example} is stored under another {self.partition}")
        inside = [e for e in clashes if e.folder in touched]
        if inside:
            # The same key may be stored in a folder of the load's days and belong to another of them.
            places = self._rows(inside).select(*self.keys, F.col(self.partition).alias("_stored"))
            other = places.join(new.select(*self.keys, self.partition), self.keys)
            example = other.where(~F.col("_stored").eqNullSafe(F.col(self.partition))).select(*self.keys).first()
            if example is not None:
                raise ValueError(f"{self.path}: {example} is stored under another {self.partition}")
        kept = [e for e in entries if e not in inside]
        # Rows that stay keep the commits they came with.
        for load in dict.fromkeys(e.load for e in inside):
            part = [e for e in inside if e.load == load]
            rest = self._rows(part).join(known, self.keys, "left_anti")
            kept += self._written(rest, max(e.taken for e in part), (min(e.since for e in part), max(e.commit for e in part)))
        return kept + made

    def _written(self, rows: DataFrame, taken: int, commits: tuple[int, int] = (0, 0)) -> list[Row]:
        """Write a load and its index; its entries, stamped when committed unless `commits` are given."""
        load = f"l{uuid.uuid4().hex}"
        where = f"{self.path}/data/load={load}"
        write_partitioned(rows, where, self.partition)
        names = [name for name, _ in self._listed(f"data/load={load}") if name.startswith(f"{self.partition}=")]
        if not names:
            discard(self.spark, where)
            return []
        keys = F.struct(*self.keys) if self.keys else F.lit(None).cast("struct<none:int>")
        stored = self.spark.read.parquet(where).select(_folder().alias("folder"), keys.alias("key"))
        sizes = stored.groupBy("folder").agg(F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        # One row per folder written.
        made = [
            Row(load=load, taken=taken, since=commits[0], commit=commits[1], bits=_filter_bits(r["rows"]), loaded_at=now, **r.asDict())
            for r in sizes.collect()
        ]
        if self.keys:
            self._filters(stored, made).write.parquet(f"{self.path}/index/load={load}")
        return made

    # --- the key index -----------------------------------------------------------

    def _filters(self, stored: DataFrame, made: list[Row]) -> DataFrame:
        """Bloom filters of the folders of (folder, key) rows, a row per word that is not zero."""
        sizes = self.spark.createDataFrame([(e.folder, e.bits) for e in made], "folder string, bits bigint")
        # Broadcast: one row per folder written. The plan does not grow with them.
        sized = stored.join(F.broadcast(sizes), "folder")
        probes = sized.select("folder", F.explode(_probes(F.col("bits"))).alias("probe"))
        words = probes.groupBy("folder", F.shiftright("probe", 5).alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(probe % 32 as int)))").alias("bits")
        )
        return words.sortWithinPartitions("folder", "word")

    def _candidates(self, entries: list[Row], made: list[Row], known: DataFrame) -> list[Row]:
        """Entries that may hold one of the load's keys, by range, then by Bloom filter."""
        low, high = min(e.low for e in made), max(e.high for e in made)
        near = [e for e in entries if e.low <= high and e.high >= low]
        load_rows = sum(e.rows for e in made)
        # A filter pays where the load has fewer keys than the folder.
        asked = [e for e in near if PROBES * load_rows <= e.rows]
        if not asked:
            return near
        ids = self.spark.createDataFrame([(e.load, e.folder, e.bits) for e in asked], "load string, folder string, bits bigint")
        index = self.spark.read.option("basePath", f"{self.path}/index").parquet(
            *[f"{self.path}/index/load={load}" for load in dict.fromkeys(e.load for e in asked)]
        )
        every = F.collect_list(F.struct("load", "folder", "bits"))
        folders = ids.groupBy().agg(every.alias("folders"))  # one row, the list `asked`
        tried = known.withColumn("folder_list", folders.scalar()).select(
            F.struct(*self.keys).alias("key"), F.explode("folder_list").alias("e")
        )
        probes = tried.select("key", "e.load", "e.folder", F.explode(F.array_distinct(_probes(F.col("e.bits")))).alias("probe"))
        probes = probes.withColumn("word", F.shiftright("probe", 5))
        found = probes.join(index, ["load", "folder", "word"], "left")
        hit = F.expr("coalesce((bits & shiftleft(1L, cast(probe % 32 as int))) <> 0, false)")
        found = found.groupBy("load", "folder", "key").agg(F.bool_and(hit).alias("all"))
        passed = {(r.load, r.folder) for r in found.where("all").select("load", "folder").distinct().collect()}
        return [e for e in near if e not in asked or (e.load, e.folder) in passed]

    def _holding(self, entries: list[Row], known: DataFrame) -> list[Row]:
        """Entries that do hold one of the keys; only key columns are read."""
        rows = self._rows(entries, located=True)
        if rows is None:
            return []
        stored = rows.select("load", _folder().alias("folder"), *self.keys)
        found = {tuple(r) for r in stored.join(known, self.keys, "left_semi").select("load", "folder").distinct().collect()}
        return [e for e in entries if (e.load, e.folder) in found]

    # --- files -------------------------------------------------------------------

    def _schema(self, entries: list[Row]) -> T.StructType:
        key = T.StructType([T.StructField("none", T.IntegerType())])
        if entries and self.keys:
            key = self._rows(entries[:1]).select(F.struct(*self.keys).alias("key")).schema["key"].dataType
        return T.StructType(
            [T.StructField(n, T.StringType()) for n in ("load", "folder")]
            + [T.StructField(n, T.LongType()) for n in ("taken", "since", "commit", "rows", "bits")]
            + [T.StructField("loaded_at", T.TimestampType())]
            + [T.StructField(n, key) for n in ("low", "high")]
        )

    def _located(self, path: str):
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self.spark._jsc.hadoopConfiguration()), location

    def _listed(self, part: str) -> list[tuple[str, int]]:
        """(name, modification time) of what lies below a folder of the table."""
        files, location = self._located(f"{self.path}/{part}")
        if not files.exists(location):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(location)]
