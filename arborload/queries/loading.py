"""Tables and whole loads."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.operators import quality
from arborload.operators.changes import delete_by_key
from arborload.operators.metrics import Metrics
from arborload.operators.project import Projections
from arborload.plans.config import Feed, Mode
from arborload.plans.load import Outcome, load_csv, run
from arborload.queries import fixtures as X
from arborload.queries.flattening import BY_HASH, HEADER_COLUMNS, TEXTS_SQL, doc_sql, row_digest, show_volatile
from arborload.queries.registry import query
from arborload.sinks.tables import BUCKET, Tables
from arborload.sources.landing import Granularity
from arborload.sources.scratch import remove

BUCKETS = 8


def _tables(spark: SparkSession) -> Tables:
    name = f"arborload_{uuid.uuid4().hex[:12]}"
    return Tables(spark, name, X.scratch_dir(spark, "tables"), BUCKETS)


@query("table_read", "SELECT * FROM orders")
def table_read(spark: SparkSession, sf: str) -> DataFrame:
    tables = _tables(spark)
    tables.append(X.table(spark, sf, "orders"), "orders")
    return tables.read("orders")


@query("table_append", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def table_append(spark: SparkSession, sf: str) -> DataFrame:
    """Columns are matched by name, whatever their order."""
    tables, orders = _tables(spark), X.table(spark, sf, "orders")
    tables.append(orders, "orders")
    tables.append(orders.select(*reversed(orders.columns)), "orders")
    return tables.read("orders")


@query(
    "stage_like_target",
    "SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus, false AS old FROM orders",
)
def stage_like_target(spark: SparkSession, sf: str) -> DataFrame:
    """The stage is recreated with the target's columns, filled by name, and dropped."""
    tables, orders = _tables(spark), X.table(spark, sf, "orders")
    target = T.StructType(
        [orders.schema[c] for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")]
    )
    tables.create("orders", target)
    tables.stage(orders.select("o_orderkey"), "orders")
    staged = tables.stage(orders.select("o_totalprice", "o_custkey", "o_orderkey"), "orders")
    rows = tables.read(staged)
    tables.append(rows, "shown")
    tables.drop(staged)
    return tables.read("shown").withColumn("old", F.lit(tables.exists(staged)))


@query("table_replace", "SELECT * FROM customer WHERE c_acctbal >= 0")
def table_replace(spark: SparkSession, sf: str) -> DataFrame:
    """A table is replaced by rows computed from itself."""
    tables = _tables(spark)
    tables.append(X.table(spark, sf, "customer"), "customer")
    tables.replace("customer", tables.read("customer").where("c_acctbal >= 0"))
    return tables.read("customer")


@query(
    "batch_metrics",
    """
    SELECT 'read_count' AS metric, 'lineitem' AS entity, 'Count' AS unit, count(*) AS value, 'run-1' AS run_id
    FROM lineitem
    UNION ALL
    SELECT 'read_count', 'documents', 'Count',
           (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)), 'run-1'
    UNION ALL
    SELECT 'repeated_rows', 'documents', 'Count',
           (SELECT count(*) FROM (SELECT 1 FROM documents GROUP BY text, lang, source, n_chars
                                  HAVING count(*) > 1)), 'run-1'""",
)
def batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Counts gathered by the writes themselves, without another pass."""
    tables, metrics = _tables(spark), Metrics(X.RUN_ID)
    tables.append(metrics.rows(X.table(spark, sf, "lineitem"), "lineitem"), "lineitem")
    seen = metrics.observation("documents", {"rows_kept": "read_count", "rows_repeated": "repeated_rows"})
    texts = X.table(spark, sf, "documents").drop("doc_id")
    tables.append(quality.dedupe(texts, observe=seen), "documents")
    return metrics.to_df(spark)


# -- whole loads -------------------------------------------------------------


def _feed(landing: str, **changes) -> Feed:
    settings = dict(
        source="text",
        name="feed",
        landing=landing,
        schema=X.DOCUMENT_SCHEMA,
        tree=X.document_tree(),
        projections=Projections(
            {
                "text_feed_document": lambda run_id: [
                    "doc_id",
                    "lang",
                    "source",
                    "n_chars",
                    f"'{run_id}' AS job_run_id",
                ],
                "text_feed_words": ["pos", "word"],
            }
        ),
        delete_path="body.doc_id",
    )
    return Feed(**{**settings, **changes})


def _batch(spark: SparkSession, docs: DataFrame, name: str) -> str:
    path = X.scratch_dir(spark, name)
    X.land(docs, X.AS_OF, path)
    return path


def _run(spark: SparkSession, docs: DataFrame, mode: Mode, tables: Tables, **changes) -> Outcome:
    """Land a batch, run it, and remove its landing area, which no later run reads."""
    landing = _batch(spark, docs, f"batch-{mode.value}")
    reports = X.scratch_dir(spark, "reports")
    done = run(spark, _feed(landing, **changes), mode, tables, X.RUN_ID, Granularity.TODAY, X.AS_OF, reports)
    remove(spark, landing)
    return done


SHOWN = {
    "document": [*HEADER_COLUMNS, "doc_id", "lang", "source", "n_chars", "lines_fk", "clauses_fk", "job_run_id"],
    "lines": ["document_id", "pos", "line", "line_chars", "words_fk"],
    "words": ["lines_id", "pos", "word"],
    "clauses": ["document_id", "pos", "clause"],
}


def _content(tables: Tables) -> DataFrame:
    """Rows of the loaded tables: table name, tree, batch and a digest of all other columns."""
    parts = []
    for table, columns in SHOWN.items():
        rows = tables.read(f"text_feed_{table}")
        digest = F.expr(row_digest(columns).replace("{text}", "STRING")).alias("content")
        parts.append(rows.select(F.lit(table).alias("table_name"), "root_key", "batch_id", digest))
    return reduce(DataFrame.unionByName, parts)


def _content_sql(texts: str = TEXTS_SQL, roots: str = "true") -> str:
    """The same rows in SQL for the documents that satisfy ``roots``; versions differ by their hash."""
    sources = {"document": "roots", "lines": "line_rows", "words": "words", "clauses": "clauses"}
    known = {**HEADER_COLUMNS, "job_run_id": "'run-1'", "line_chars": "length(line)"}
    parts = []
    for table, source in sources.items():
        digest = row_digest([known.get(c, c) for c in SHOWN[table]]).replace("{text}", "VARCHAR")
        parts.append(
            f"SELECT '{table}' AS table_name, root_key, 'run-1' AS batch_id, {digest} AS content FROM {source} "
            f"WHERE root_key IN (SELECT root_key FROM docs WHERE {roots})"
        )
    return doc_sql(texts, BY_HASH) + " UNION ALL ".join(parts)


@query("load_bulk", _content_sql())
def load_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """Every document landed twice in one batch: the copies are removed."""
    tables, docs = _tables(spark), X.documents(spark, sf)
    _run(spark, docs.unionByName(docs), Mode.BULK, tables)
    return _content(tables)


FRENCH_UPPER = f"SELECT * REPLACE (upper(text) AS text) FROM ({TEXTS_SQL}) WHERE lang = 'fr'"
NOT_FRENCH = f"SELECT * FROM ({TEXTS_SQL}) WHERE lang <> 'fr'"
ALL_WITH_FRENCH_UPPER = f"SELECT * FROM ({TEXTS_SQL}) UNION {FRENCH_UPPER}"


def _french_upper(spark: SparkSession, sf: str) -> DataFrame:
    return X.documents_of(X.texts(spark, sf).where("lang = 'fr'").withColumn("text", F.upper("text")))


@query("load_versions", _content_sql(ALL_WITH_FRENCH_UPPER))
def load_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two differing documents per French root in one batch: each keeps its own subtree."""
    tables = _tables(spark)
    _run(spark, X.documents(spark, sf).unionByName(_french_upper(spark, sf)), Mode.BULK, tables)
    return _content(tables)


SHARED_HASH = {"fr": None, "es": bytes(1)}


@query(
    "load_shared_hash",
    f"""
    WITH versions AS (
        SELECT doc_id, n_chars, text, lang FROM ({TEXTS_SQL})
        UNION SELECT doc_id, -n_chars, upper(text), lang FROM ({TEXTS_SQL}) WHERE lang IN ('fr', 'es'))
    SELECT doc_id, n_chars, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
           unnest(string_split(text, chr(10))) AS line
    FROM versions WHERE lang <> '{X.NO_LINES}'""",
)
def load_shared_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Versions whose record hash is NULL (French) or the same (Spanish) keep their own lines."""
    tables = _tables(spark)
    texts = X.texts(spark, sf)
    second = texts.where("lang IN ('fr', 'es')").withColumn("text", F.upper("text")).withColumn("n_chars", -F.col("n_chars"))
    docs = X.documents_of(texts.unionByName(second))
    value = F.col("header.recordHash")
    for lang, shared in SHARED_HASH.items():
        value = F.when(F.col("body.lang") == lang, F.lit(shared).cast("binary")).otherwise(value)
    docs = docs.withColumn("header", F.col("header").withField("recordHash", value))
    _run(spark, docs, Mode.BULK, tables)
    parent, child = tables.read("text_feed_document"), tables.read("text_feed_lines")
    joined = parent.join(child, parent["lines_fk"] == child["document_id"])
    return joined.select(parent["doc_id"], parent["n_chars"], child["pos"], child["line"])


LATER = "2024-02-02T00:00:00Z"


@query(
    "load_latest",
    _content_sql(f"{NOT_FRENCH} UNION ALL SELECT * REPLACE ('{LATER}' AS ingested) FROM ({FRENCH_UPPER})"),
)
def load_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Of two documents per French root the later one is loaded."""
    tables = _tables(spark)
    later = _french_upper(spark, sf).withColumn("header", F.col("header").withField("ingestDateTime", F.lit(LATER)))
    _run(spark, later.unionByName(X.documents(spark, sf)), Mode.BULK, tables, on_duplicate_root="latest")
    return _content(tables)


@query(
    "load_newest",
    _content_sql(f"{NOT_FRENCH} UNION ALL SELECT * REPLACE ('{LATER}' AS ingested) FROM ({FRENCH_UPPER})"),
)
def load_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The later batch comes first: of the earlier one its French roots pass by, and are counted."""
    tables, docs = _tables(spark), X.documents(spark, sf)
    later = _french_upper(spark, sf).withColumn("header", F.col("header").withField("ingestDateTime", F.lit(LATER)))
    _run(spark, later, Mode.UPSERT, tables, on_duplicate_root="newest")
    done = _run(spark, docs, Mode.UPSERT, tables, on_duplicate_root="newest")
    skipped = next(v for m, _, _, v, _ in done.metrics.records() if m == "skipped_roots")
    assert skipped == docs.where("body.lang = 'fr'").count()
    return _content(tables)


@query(
    "load_rejects",
    """
    SELECT source, count(*) AS rejected, (SELECT count(*) FROM documents WHERE lang = 'fr') AS metric
    FROM documents WHERE lang = 'fr' GROUP BY source""",
)
def load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a key are written and counted, also without a reports folder."""
    tables = _tables(spark)
    key = F.when(F.col("body.lang") != "fr", F.col("body.doc_id"))
    docs = X.documents(spark, sf).withColumn("body", F.col("body").withField("doc_id", key))
    feed = _feed(_batch(spark, docs, "rejects"))
    done = run(spark, feed, Mode.BULK, tables, X.RUN_ID, Granularity.TODAY, X.AS_OF)
    metric = next(v for m, _, _, v, _ in done.metrics.records() if m == "rejected_rows")
    lost = spark.read.parquet(done.rejected).groupBy(F.col("body.source").alias("source"))
    return lost.agg(F.count(F.lit(1)).alias("rejected")).withColumn("metric", F.lit(metric).cast("bigint"))


@query("load_filtered", _content_sql(f"SELECT * FROM ({TEXTS_SQL}) WHERE n_chars > 500 AND lang <> 'de'"))
def load_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """A filter over the tree; every table reads its own columns and those of the filter."""
    tables = _tables(spark)
    where = "body.n_chars > 500 AND body.lang <> 'de'"
    _run(spark, X.documents(spark, sf), Mode.BULK, tables, where=where)
    return _content(tables)


UPSERTED = f"""{NOT_FRENCH} UNION ALL {FRENCH_UPPER}
    UNION ALL SELECT * REPLACE (doc_id + 1000000000 AS doc_id) FROM ({TEXTS_SQL}) WHERE lang = 'es'"""


@query("load_upsert", _content_sql(UPSERTED))
def load_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """French texts change, Spanish ones are added under new keys; applied twice."""
    tables = _tables(spark)
    _run(spark, X.documents(spark, sf), Mode.BULK, tables)
    added = X.documents_of(
        X.texts(spark, sf).where("lang = 'es'").withColumn("doc_id", F.col("doc_id") + 1_000_000_000)
    )
    batch = _french_upper(spark, sf).unionByName(added)
    for _ in range(2):
        _run(spark, batch, Mode.UPSERT, tables)
    return _content(tables)


@query("load_incremental", _content_sql(f"{NOT_FRENCH} UNION ALL {FRENCH_UPPER}"))
def load_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """New files are upserted, batch by batch; a run without new files changes nothing."""
    tables = _tables(spark)
    landing = _batch(spark, X.documents(spark, sf), "incremental")
    state = X.scratch_dir(spark, "incremental-state")

    def load() -> Outcome:
        return run(spark, _feed(landing), Mode.UPSERT, tables, X.RUN_ID, Granularity.NEW, X.AS_OF, state=state)

    load()
    X.land(_french_upper(spark, sf), X.AS_OF, landing)
    load()
    assert not load().metrics.records()
    remove(spark, landing)
    return _content(tables)


class _Breaking(Tables):
    """Tables whose root can't be appended to."""

    def append(self, frame: DataFrame, table: str, *args, **settings) -> None:
        if table == "text_feed_document":
            raise OSError("no space left")
        super().append(frame, table, *args, **settings)


@query("load_append_once", _content_sql())
def load_append_once(spark: SparkSession, sf: str) -> DataFrame:
    """Two waves of new files are appended; the second breaks off half-way and is repeated."""
    tables = _tables(spark)
    docs = X.documents(spark, sf)
    landing = _batch(spark, docs.where("body.lang <> 'en'"), "append")
    state = X.scratch_dir(spark, "append-state")

    def load(target: Tables) -> Outcome:
        return run(spark, _feed(landing), Mode.BULK, target, X.RUN_ID, Granularity.NEW, X.AS_OF, state=state)

    load(tables)
    X.land(docs.where("body.lang = 'en'"), X.AS_OF, landing)
    try:
        load(_Breaking(spark, tables.database, tables.location))
    except StreamingQueryException:
        pass
    for _ in range(2):
        load(tables)
    remove(spark, landing)
    return _content(tables).withColumn("batch_id", F.split("batch_id", "/")[0])


@query("load_digest_first", _content_sql())
def load_digest_first(spark: SparkSession, sf: str) -> DataFrame:
    """Documents landed twice; copies are found by their digests before any whole row is shuffled."""
    tables, docs = _tables(spark), X.documents(spark, sf)
    _run(spark, docs.unionByName(docs), Mode.BULK, tables, digest_first=True)
    return _content(tables)


@query("load_delete", _content_sql(roots="lang <> 'en'"))
def load_delete(spark: SparkSession, sf: str) -> DataFrame:
    """English texts are deleted with everything below them, unknown keys are not found."""
    tables = _tables(spark)
    docs = X.documents(spark, sf)
    _run(spark, docs, Mode.BULK, tables)
    gone = docs.where("body.lang = 'en'")
    unknown = docs.where("body.lang = 'de'").withColumn(
        "body", F.col("body").withField("doc_id", -1 - F.col("body.doc_id"))
    )
    _run(spark, gone.unionByName(unknown), Mode.DELETE, tables)
    return _content(tables)


@query(
    "load_delete_report",
    doc_sql(row_key=BY_HASH)
    + """
    SELECT 'document' AS table, count(*) AS delete_count FROM roots WHERE lang = 'en'
    UNION ALL SELECT 'lines', count(*) FROM roots WHERE lang = 'en'
    UNION ALL SELECT 'clauses', count(*) FROM roots WHERE lang = 'en'
    UNION ALL SELECT 'words', count(*) FROM line_rows
              WHERE root_key IN (SELECT root_key FROM docs WHERE lang = 'en')
    UNION ALL SELECT 'unmatched', count(*) FROM documents WHERE lang = 'de'""",
)
def load_delete_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report files of a delete run."""
    tables = _tables(spark)
    docs = X.documents(spark, sf)
    _run(spark, docs, Mode.BULK, tables)
    gone = docs.where("body.lang = 'en'")
    unknown = docs.where("body.lang = 'de'").withColumn(
        "body", F.col("body").withField("doc_id", -1 - F.col("body.doc_id"))
    )
    done = _run(spark, gone.unionByName(unknown), Mode.DELETE, tables)
    report = spark.read.option("header", True).schema("table string, delete_count bigint").csv(done.report)
    lost = spark.read.option("header", True).schema("doc_id bigint").csv(done.unmatched)
    return report.unionByName(
        lost.agg(F.count(F.lit(1)).alias("delete_count")).select(
            F.lit("unmatched").alias("table"), "delete_count"
        )
    )


def _flat_feed(landing: str, **changes) -> Feed:
    return Feed(
        source="text",
        name="flat",
        landing=landing,
        schema=X.DOCUMENT_SCHEMA,
        key="doc_id",
        projections=Projections(
            {
                "text_flat": lambda run_id: [
                    "body.doc_id AS doc_id",
                    "upper(body.lang) AS language",
                    "body.source AS source",
                    "body.n_chars AS n_chars",
                    "size(body.lines) AS n_lines",
                    f"'{run_id}' AS job_run_id",
                ]
            }
        ),
        delete_path="body.doc_id",
        **changes,
    )


def _flat_sql(texts: str) -> str:
    header = ", ".join(
        f"{'sourceZipArchive' if 'nullif' in sql else sql} AS {name}" for name, sql in HEADER_COLUMNS.items()
    )
    return f"""{doc_sql(texts)}
    SELECT {header}, true AS loaded_as_of, true AS has_file, roots.doc_id, upper(roots.lang) AS language,
           roots.source, roots.n_chars,
           CASE WHEN roots.lang <> '{X.NO_LINES}' THEN len(string_split(text, chr(10)))::INT END AS n_lines,
           'run-1' AS job_run_id
    FROM roots JOIN texts ON roots.doc_id = texts.doc_id"""


@query("load_flat", _flat_sql(TEXTS_SQL))
def load_flat(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that is not flattened: projection with header, append."""
    tables = _tables(spark)
    feed = _flat_feed(_batch(spark, X.documents(spark, sf), "flat"))
    run(spark, feed, Mode.BULK, tables, X.RUN_ID, Granularity.TODAY, X.AS_OF)
    return show_volatile(tables.read("text_flat").drop(BUCKET))


@query("load_flat_filtered", _flat_sql(f"SELECT * FROM ({TEXTS_SQL}) WHERE n_chars > 100"))
def load_flat_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a filter, which reaches the scan."""
    tables = _tables(spark)
    feed = _flat_feed(_batch(spark, X.documents(spark, sf), "flat"), where="body.n_chars > 100")
    run(spark, feed, Mode.BULK, tables, X.RUN_ID, Granularity.TODAY, X.AS_OF)
    return show_volatile(tables.read("text_flat").drop(BUCKET))


@query(
    "load_flat_upsert",
    _flat_sql(f"SELECT * FROM ({UPSERTED.replace('upper(text)', 'upper(text) || chr(10)')}) WHERE lang <> 'de'"),
)
def load_flat_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a flat feed are replaced by key, added and deleted; only their buckets change."""
    tables = _tables(spark)
    changed = X.texts(spark, sf).where("lang = 'fr'").withColumn("text", F.concat(F.upper("text"), F.lit("\n")))
    added = X.texts(spark, sf).where("lang = 'es'").withColumn("doc_id", F.col("doc_id") + 1_000_000_000)
    gone = X.documents(spark, sf).where("body.lang = 'de'")
    batches = [
        (X.documents(spark, sf), Mode.BULK),
        (X.documents_of(changed.unionByName(added)), Mode.UPSERT),
        (gone, Mode.DELETE),
    ]
    for docs, mode in batches:
        feed = _flat_feed(_batch(spark, docs, "flat"))
        run(spark, feed, mode, tables, X.RUN_ID, Granularity.TODAY, X.AS_OF)
    return show_volatile(tables.read("text_flat").drop(BUCKET))


@query(
    "load_flat_rejects",
    f"""SELECT *, (SELECT count(*) FROM documents WHERE lang = 'fr') AS rejected
        FROM ({_flat_sql(NOT_FRENCH)})""",
)
def load_flat_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a flat feed without a key are rejected; the same upsert twice changes nothing."""
    tables = _tables(spark)
    key = F.when(F.col("body.lang") != "fr", F.col("body.doc_id"))
    docs = X.documents(spark, sf).withColumn("body", F.col("body").withField("doc_id", key))
    feed = _flat_feed(_batch(spark, docs, "flat"))
    for _ in range(2):
        done = run(spark, feed, Mode.UPSERT, tables, X.RUN_ID, Granularity.TODAY, X.AS_OF)
    rejected = next(v for m, _, _, v, _ in done.metrics.records() if m == "rejected_rows")
    rows = show_volatile(tables.read("text_flat").drop(BUCKET))
    return rows.withColumn("rejected", F.lit(rejected).cast("bigint"))


@query(
    "load_flat_latest",
    _flat_sql(f"{NOT_FRENCH} UNION ALL SELECT * REPLACE ('{LATER}' AS ingested) FROM ({FRENCH_UPPER})"),
)
def load_flat_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Of two documents per French key of a flat feed the later one is loaded."""
    tables = _tables(spark)
    later = _french_upper(spark, sf).withColumn("header", F.col("header").withField("ingestDateTime", F.lit(LATER)))
    batch = _batch(spark, later.unionByName(X.documents(spark, sf)), "flat")
    feed = _flat_feed(batch, on_duplicate_root="latest")
    run(spark, feed, Mode.UPSERT, tables, X.RUN_ID, Granularity.TODAY, X.AS_OF)
    return show_volatile(tables.read("text_flat").drop(BUCKET))


WANTED_ORDERS = "o_orderkey % 97 = 0"


@query("lookup_orders", f"SELECT * FROM orders WHERE {WANTED_ORDERS}")
def lookup_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by key from a table that is sorted by it and carries Bloom filters."""
    orders = X.table(spark, sf, "orders")
    tables = Tables(spark, f"arborload_{uuid.uuid4().hex[:12]}", X.scratch_dir(spark, "tables"), BUCKETS, indexed=True)
    tables.append(orders, "orders", key="o_orderkey")
    return tables.lookup("orders", orders.where(WANTED_ORDERS).select("o_orderkey"))


CLUSTERS = 8


@query("delete_clustered", "SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 7 = 0)")
def delete_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Line items of some customers go; the table is clustered by order, so only keys are exchanged."""
    tables = _tables(spark)
    target = tables.cluster("lineitem", X.table(spark, sf, "lineitem"), "l_orderkey", CLUSTERS)
    gone = X.table(spark, sf, "orders").where("o_custkey % 7 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return delete_by_key(target, gone, "l_orderkey")


@query(
    "load_csv_damaged",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority,
           (SELECT count(*) FROM orders WHERE o_orderkey % 3 < 2) AS rejected
    FROM orders WHERE o_orderkey % 3 = 2""",
)
def load_csv_damaged(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a field too many or too few are set apart and counted; the others are loaded."""
    rows = X.table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    line = F.concat_ws(",", *columns)
    kind = F.col("o_orderkey") % 3
    line = F.when(kind == 0, F.concat(line, F.lit(",more"))).when(kind == 1, F.col("o_orderkey").cast("string")).otherwise(line)
    source = X.scratch_dir(spark, "csv")
    # Every file begins with the header.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    header = F.lit(",".join(columns) + "\n")
    rows.select(F.when(first, F.concat(header, line)).otherwise(line).alias("value")).write.text(source)
    tables = _tables(spark)
    done = load_csv(spark, source, X.scratch_dir(spark, "csv-landing"), "order", "shop_order", tables, X.RUN_ID, columns=columns)
    rejected = next(v for m, _, _, v, _ in done.metrics.records() if m == "rejected_rows")
    return tables.read("shop_order").withColumn("rejected", F.lit(rejected).cast("bigint"))


@query(
    "load_csv",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, lower(o_orderstatus) AS o_orderstatus,
           o_orderpriority, 'run-1' AS job_run_id FROM orders""",
)
def csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV feed is converted, landed and appended."""
    rows = X.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    source = X.scratch_dir(spark, "csv")
    rows.write.option("header", True).csv(source)

    def order(frame: DataFrame, run_id: str) -> DataFrame:
        return frame.withColumn("o_orderstatus", F.lower("o_orderstatus")).withColumn(
            "job_run_id", F.lit(run_id)
        )

    tables = _tables(spark)
    landing = X.scratch_dir(spark, "csv-landing")
    load_csv(
        spark, source, landing, "order", "shop_order", tables, X.RUN_ID, {"order": order}, rows.columns
    )
    return tables.read("shop_order")
