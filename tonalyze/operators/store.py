"""Predictions store: append, clear, schema migration, unified read.

A store is a folder of write-once data and small commits:

    data/<write>/...         files of one write (parquet or JSON lines)
    commits/<batch>.json     the write that holds a batch, its files and rows;
                             a batch that is sent again replaces its commit
    changes/<id>.json        writes that a clear took out or a migration
                             replaced, all in one file

What a reader sees is decided by commits and changes alone, and each of them
is put in place whole.  So an append, a clear and a migration are one act
each: a reader sees the store before it or after it.  Changes name writes,
which are never used again, and not the state of the store.  Hence a batch
that is appended while a clear or a migration runs is neither lost nor half
seen: it is no write that the change names, and stays.

Commits hold their row counts (observed while the rows are written), so a
clear reads no data; a migration counts in the pass that rewrites.  A clear
takes nothing off the disk; ``purge`` does, for writes that no reader can see.

Driver state is one entry per live batch.  A folder with anything else in it
is refused, for reading and for writing, rather than read in part;
``migrate_store`` takes rows from any folder into a new store.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote, unquote

from pyarrow.fs import FileSelector, FileType
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tonalyze.fixed import STORED_STATE
from tonalyze.functions.formatting import utc_ntz
from tonalyze.sources import documents
from tonalyze.streaming.sink import filesystem, put

# Columns of a stored prediction, in order.
STORE_COLUMNS = ("id", "texto", "prediccion", "probability", "ts", "estado")
STORE_SCHEMA = ("id string, texto string, prediccion string, probability array<double>, "
                "ts timestamp_ntz, estado string")
# ... and the fields that only documents of the older schema have.
DOCUMENT_SCHEMA = f"{STORE_SCHEMA}, intencion_predicha string, confianza double"
BATCH_COLUMN = "lote"


def enrich_for_store(scored: DataFrame, id_col: str | None = None,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Stored-document shape of a batch of scored rows.

    * ``id``: the given key as text, or a generated one (``uuid()``).
    * ``ts``: the row's time if it has one, else the current UTC time.
    * ``estado``: constant ``almacenado``.
    """
    ident = F.col(id_col).cast("string") if id_col else F.expr("uuid()")
    ts = F.col("ts") if "ts" in scored.columns else F.lit(None).cast("timestamp_ntz")
    now = utc_ntz(F.current_timestamp())
    prob = (F.col("probability") if "probability" in scored.columns
            else F.lit(None).cast("array<double>"))
    return scored.select(
        ident.alias("id"),
        F.col("texto"),
        F.col("prediccion"),
        prob.alias("probability"),
        F.coalesce(ts.cast("timestamp_ntz"), now).alias("ts"),
        F.lit(STORED_STATE).alias("estado"),
        *keep,
    )


# -- commits ---------------------------------------------------------------

def _read_small(spark: SparkSession, folder: str) -> dict[str, dict]:
    """Content of the small files of a folder by name; none if it is missing."""
    files, at = filesystem(folder)
    if files.get_file_info(at).type == FileType.NotFound:
        return {}
    rows = (spark.read.option("wholetext", "true").text(folder)
            .select("value", F.col("_metadata.file_name").alias("name")).collect())
    # the metadata column is URI-escaped, and so is the name itself
    return {unquote(unquote(r["name"])).removesuffix(".json"): json.loads(r["value"]) for r in rows}


def _file_name(batch: str) -> str:
    return quote(batch, safe="") + ".json"


def _is_store(path: str) -> bool:
    """Is there a store at ``path``?  False if there is nothing at all."""
    files, at = filesystem(path)
    names = {f.base_name for f in files.get_file_info(FileSelector(at, allow_not_found=True))}
    if names <= {"commits", "changes", "data", "rejected"}:
        return "commits" in names
    raise ValueError(f"{path} holds rows outside the commits of a store: rewrite it with migrate_store")


def live_batches(spark: SparkSession, path: str) -> dict[str, dict]:
    """The write that holds each batch a reader sees, by batch name."""
    if not _is_store(path):
        return {}
    instead: dict[str, dict | None] = {}
    for _, change in sorted(_read_small(spark, f"{path}/changes").items()):
        for write, entry in change.items():
            if entry is None or write not in instead:      # taken out wins
                instead[write] = entry
    live = {}
    for batch, entry in _read_small(spark, f"{path}/commits").items():
        while entry is not None and entry["write"] in instead:
            entry = instead[entry["write"]]
        if entry is not None:
            live[batch] = entry
    return live


def _read(spark: SparkSession, path: str, entries: list[dict], schema: str, mark: str | None = None) -> DataFrame:
    """Rows of the given writes; ``mark`` adds the folder they lie in."""
    folder = F.regexp_extract("_metadata.file_path", f"/(data/[^/]+(?:/{BATCH_COLUMN}=[0-9]+)?)/[^/]*$", 1)
    kept, marks = [n for n, _ in documents.fields(schema)], [folder.alias(mark)] if mark else []
    parts = []
    for fmt in sorted({e["format"] for e in entries}):
        folders = [f"{path}/{f}" for e in entries if e["format"] == fmt for f in e["paths"]]
        if not folders:
            continue
        if fmt == "json":
            lines = spark.read.text(folders).select("value", *marks)
            parts.append(documents.accepted(documents.parse_documents(lines, schema)))
        else:
            parts.append(spark.read.schema(schema).format(fmt).load(folders).select(*kept, *marks))
    if not parts:
        return spark.createDataFrame([], schema + (f", {mark} string" if mark else ""))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _write_numbered(rows: DataFrame, path: str, batches: int) -> list[dict]:
    """Write rows of several batches, numbered by their column ``lote``, in one
    job; returns an entry for each number."""
    folder = f"data/{uuid.uuid4().hex}"
    rows.select(*STORE_COLUMNS, BATCH_COLUMN).write.partitionBy(BATCH_COLUMN).parquet(f"{path}/{folder}")
    written = rows.sparkSession.read.schema(f"{STORE_SCHEMA}, {BATCH_COLUMN} int").parquet(f"{path}/{folder}")
    sizes = {r[0]: r[1] for r in written.groupBy(BATCH_COLUMN).agg(F.count(F.lit(1))).collect()}
    return [{"write": uuid.uuid4().hex, "format": "parquet", "rows": sizes.get(k, 0),
             "paths": [f"{folder}/{BATCH_COLUMN}={k}"] if k in sizes else []} for k in range(batches)]


def _write(rows: DataFrame, path: str, fmt: str) -> tuple[dict, int]:
    """Write rows as a new write; returns its entry."""
    folder = f"data/{uuid.uuid4().hex}"
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    if fmt == "json":
        documents.encode_documents(counted).write.text(f"{path}/{folder}")
    else:
        counted.write.format(fmt).save(f"{path}/{folder}")
    return {"write": folder.removeprefix("data/"), "paths": [folder], "format": fmt, "rows": int(seen.get["n"])}


# -- appends and reads -------------------------------------------------------

def append_predictions(batch: DataFrame, path: str, fmt: str = "parquet",
                       batch_id: int | str | None = None) -> int:
    """Append one whole batch to the store; returns its rows.

    With ``batch_id`` the append is idempotent: the same batch again (a retry
    after a failure) replaces its commit instead of adding the rows twice.
    Without one the batch gets a name that no other has.  ``fmt`` is the
    format of this batch's data; batches of one store may differ.
    """
    _is_store(path)              # refuses another layout
    name = f"id-{batch_id}" if batch_id is not None else f"new-{uuid.uuid4().hex}"
    entry = _write(batch.select(*STORE_COLUMNS), path, fmt)
    put(f"{path}/commits", _file_name(name), entry)
    return entry["rows"]


def append_batches(rows: DataFrame, path: str) -> int:
    """Append rows that carry their batch's name (``lote``), each batch as a
    commit of its own, in one job; returns how many rows there were."""
    spark = rows.sparkSession
    _is_store(path)
    names = sorted(r[0] for r in rows.select(BATCH_COLUMN).distinct().collect())
    number = spark.createDataFrame(list(enumerate(names)), "_k int, _name string")
    numbered = (rows.join(number, F.col(BATCH_COLUMN) == F.col("_name")).drop(BATCH_COLUMN, "_name")
                .withColumnRenamed("_k", BATCH_COLUMN))
    entries = _write_numbered(numbered, path, len(names))
    for name, entry in zip(names, entries):
        put(f"{path}/commits", _file_name(name), entry)
    return sum(e["rows"] for e in entries)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The stored predictions of all batches."""
    if not _is_store(path):
        raise FileNotFoundError(f"no store at {path}")
    return _read(spark, path, list(live_batches(spark, path).values()), STORE_SCHEMA)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the store's JSON batches that are no documents of its schema."""
    folders = [f"{path}/{f}" for e in live_batches(spark, path).values() if e["format"] == "json" for f in e["paths"]]
    if not folders:
        return spark.createDataFrame([], "value string, motivo string")
    return documents.rejected(documents.parse_documents(spark.read.text(folders), DOCUMENT_SCHEMA))


# -- maintenance -------------------------------------------------------------

def clear_predictions(spark: SparkSession, path: str) -> int:
    """Delete every stored prediction; returns how many there were.

    One change names the writes of all batches seen; the count is theirs.
    """
    live = live_batches(spark, path)
    put(f"{path}/changes", f"{uuid.uuid4().hex}.json", {e["write"]: None for e in live.values()})
    return sum(e["rows"] for e in live.values())


def purge(spark: SparkSession, path: str) -> int:
    """Delete the files of writes that were cleared or replaced by a change;
    returns how many folders went.  Readers that started before may need them."""
    live = {f for e in live_batches(spark, path).values() for f in e["paths"]}
    every = list(_read_small(spark, f"{path}/commits").values())
    for change in _read_small(spark, f"{path}/changes").values():
        every += [e for e in change.values() if e is not None]
    gone = 0
    for folder in {f for e in every for f in e["paths"]} - live:
        files, at = filesystem(f"{path}/{folder}")
        if files.get_file_info(at).type != FileType.NotFound:
            files.delete_dir(at)
            gone += 1
    return gone


def migrate_predictions(legacy: DataFrame) -> DataFrame:
    """Unified schema: class from ``intencion_predicha`` when ``prediccion``
    is missing, and the stored ``confianza`` dropped (it is derived from the
    probability vector when needed).  Applying it twice equals applying it once.
    """
    out = legacy
    if "intencion_predicha" in out.columns:
        out = out.withColumn("prediccion", F.coalesce(F.col("prediccion"), F.col("intencion_predicha")))
    if "confianza" in out.columns:
        out = out.drop("confianza")
    return out


def migration_changed(legacy: DataFrame):
    """Whether the migration modifies a row (a missing field equals null)."""
    cond = F.lit(False)
    if "intencion_predicha" in legacy.columns:
        cond = cond | (F.col("prediccion").isNull() & F.col("intencion_predicha").isNotNull())
    if "confianza" in legacy.columns:
        cond = cond | F.col("confianza").isNotNull()
    return cond


def migration_counts(legacy: DataFrame) -> DataFrame:
    """Matched (all rows) and modified counts of the migration, in one pass."""
    return legacy.agg(F.count(F.lit(1)).alias("matched_count"),
                      F.count_if(migration_changed(legacy)).alias("modified_count"))


def _rewritten(legacy: DataFrame, *keep: str) -> DataFrame:
    """Migrated rows with the store's columns; fields a row lacks are null."""
    for name, kind in documents.fields(DOCUMENT_SCHEMA):
        if name not in legacy.columns:
            legacy = legacy.withColumn(name, F.lit(None).cast(kind))
    kept = migrate_predictions(legacy)
    return kept.select(*[F.col(c).cast(t).alias(c) for c, t in documents.fields(STORE_SCHEMA)], *keep)


def migrate_store(spark: SparkSession, src: str, dst: str, fmt: str = "parquet",
                  schema: str | None = None, rejected: str | None = None) -> tuple[int, int]:
    """Rows of any folder, migrated, as a new store at ``dst``.

    Returns (matched, modified) like a store's update-many, counted in the
    pass that writes.  ``fmt="json"`` reads JSON lines as documents; lines
    that are none go to ``rejected`` (their text and the reason), which must
    be given then.
    """
    if _is_store(dst):
        raise ValueError(f"there is a store at {dst}")
    if fmt == "json":
        parsed = documents.parse_documents(spark.read.text(src), DOCUMENT_SCHEMA)
        documents.rejected(parsed).write.json(rejected)
        legacy = documents.accepted(parsed)
    else:
        reader = spark.read.format(fmt)
        legacy = (reader.schema(schema) if schema else reader).load(src)
    seen = Observation()
    counted = legacy.observe(seen, F.count(F.lit(1)).alias("matched"),
                             F.count_if(migration_changed(legacy)).alias("modified"))
    entry = _write(_rewritten(counted), dst, "parquet" if fmt == "json" else fmt)
    put(f"{dst}/commits", "migrated.json", entry)
    return int(seen.get["matched"]), int(seen.get["modified"])


def migrate_in_place(spark: SparkSession, path: str) -> tuple[int, int]:
    """Migrate every batch of a store; returns (matched, modified).

    The new files are written beside the old ones in one pass, and one change
    puts them in the place of the writes that were read.  Lines of JSON
    batches that are no documents are kept under ``rejected/``.
    """
    live = [e for _, e in sorted(live_batches(spark, path).items()) if e["paths"]]
    if any(e["format"] == "json" for e in live):
        read_rejected(spark, path).write.json(f"{path}/rejected/{uuid.uuid4().hex}")
    number = spark.createDataFrame([(f, k) for k, e in enumerate(live) for f in e["paths"]],
                                   f"_folder string, {BATCH_COLUMN} int")
    legacy = _read(spark, path, live, DOCUMENT_SCHEMA, mark="_folder").join(number, "_folder")
    seen = Observation()
    counted = legacy.observe(seen, F.count(F.lit(1)).alias("matched"),
                             F.count_if(migration_changed(legacy)).alias("modified"))
    entries = _write_numbered(_rewritten(counted, BATCH_COLUMN), path, len(live))
    put(f"{path}/changes", f"{uuid.uuid4().hex}.json", {old["write"]: new for old, new in zip(live, entries)})
    return int(seen.get["matched"]), int(seen.get["modified"])


def _as_ntz(df: DataFrame, name: str):
    """A time column as UTC without a zone; one that has no zone as it is."""
    if df.schema[name].dataType.simpleString() == "timestamp":
        return utc_ntz(F.col(name))
    return F.col(name).cast("timestamp_ntz")


def unified_predictions(stored: DataFrame, streamed: DataFrame) -> DataFrame:
    """One predictions table from the request path and the stream path.

    Stream rows carry ``intencion_predicha`` and ``timestamp``; stored rows
    ``prediccion`` and ``ts``.  Columns are matched by name, missing ones are
    null, then the class is unified.
    """
    if "timestamp" in streamed.columns and "ts" not in streamed.columns:
        streamed = streamed.withColumnRenamed("timestamp", "ts")
    if "ts" in streamed.columns:
        streamed = streamed.withColumn("ts", _as_ntz(streamed, "ts"))
    both = stored.unionByName(streamed, allowMissingColumns=True)
    return migrate_predictions(both)


def read_predictions(spark: SparkSession, store_path: str | None = None,
                     stream_sink: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Everything stored, in the shape the reports read.

    The request-path store and the stream sink are read and unified by
    column name; columns a source lacks are null (``intencion_predicha``,
    ``confianza``, ``etiqueta_real``), stream rows get their processing
    time as ``ts`` and the stored state.
    """
    parts = []
    if store_path:
        parts.append(read_store(spark, store_path))
    if stream_sink:
        streamed = (spark.read.format(fmt).load(stream_sink)
                    .withColumn("ts", utc_ntz(F.col("timestamp"))).drop("timestamp")
                    .withColumn("estado", F.lit(STORED_STATE)))
        parts.append(streamed)
    if not parts:
        raise ValueError("give a store path, a stream sink, or both")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    for name, kind in (("id", "string"), ("intencion_predicha", "string"), ("confianza", "double")):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out
