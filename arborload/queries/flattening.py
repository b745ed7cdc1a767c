"""Nested documents to linked tables, projections, headers, duplicates."""

from __future__ import annotations

from datetime import timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.functions.header import SOURCE_FILE, audit_header
from arborload.operators import columns, quality
from arborload.operators.flatten import flatten, flatten_from, rejects
from arborload.operators.project import Projections, project, project_tree, project_view
from arborload.plans import nominal
from arborload.queries import fixtures as X
from arborload.queries.registry import query
from arborload.sources.landing import scan
from arborload.sources.scratch import materialise
from arborload.tree import BATCH_ID, ROOT_KEY, Tree

TEXTS_SQL = f"""
        SELECT doc_id, text, lang, source, n_chars, '{X.INGESTED}' AS ingested FROM documents
        UNION ALL
        SELECT {X.EDGE_DOCUMENT} - r_regionkey, r_name,
               CASE WHEN r_regionkey % 2 = 0 THEN '{X.NO_LINES}' ELSE '{X.NO_CLAUSES}' END, 'edge',
               length(r_name), '{X.INGESTED}' FROM region"""
ONE_VERSION = "md5(concat_ws('|', 'document', doc_id))"
BY_HASH = f"md5(concat_ws('|', {ONE_VERSION}, md5(upper(sha256(text)))))"


def doc_sql(texts: str = TEXTS_SQL, row_key: str = ONE_VERSION) -> str:
    """The document tree in SQL: roots, lines, words and clauses with their links."""
    return f"""
    WITH texts AS ({texts}),
    docs AS (
        SELECT *, {ONE_VERSION} AS root_key, {row_key} AS row_key FROM texts
    ),
    lines AS (
        SELECT root_key, md5(concat_ws('|', 'lines', row_key)) AS document_id, pos - 1 AS pos, line
        FROM (
            SELECT root_key, row_key, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM docs WHERE lang <> '{X.NO_LINES}')
    ),
    line_rows AS (
        SELECT *, md5(concat_ws('|', 'words', md5(concat_ws('|', document_id, pos)))) AS words_fk FROM lines
    ),
    words AS (
        SELECT root_key, words_fk AS lines_id, pos - 1 AS pos, word
        FROM (
            SELECT root_key, words_fk, unnest(string_split(line, ' ')) AS word,
                   generate_subscripts(string_split(line, ' '), 1) AS pos
            FROM line_rows)
    ),
    clauses AS (
        SELECT root_key, md5(concat_ws('|', 'clauses', row_key)) AS document_id, pos - 1 AS pos, clause
        FROM (
            SELECT root_key, row_key, unnest(string_split(text, ', ')) AS clause,
                   generate_subscripts(string_split(text, ', '), 1) AS pos
            FROM docs WHERE lang <> '{X.NO_CLAUSES}')
    ),
    roots AS (
        SELECT unhex(sha256(text)) AS recordHash, source AS dataFeedId,
               'collect-' || lang AS collectDataFeedTaskId, 'ingest-' || lang AS ingestDataFeedTaskId,
               '2024-02-01' AS collectionDate, ingested AS ingestDateTime,
               'text' AS dataFormat, source || '/' || doc_id AS sourceFilename,
               CASE lang WHEN 'en' THEN '' WHEN 'fr' THEN source || '.zip' END AS sourceZipArchive,
               doc_id, lang, source, n_chars,
               CASE WHEN lang <> '{X.NO_LINES}' THEN md5(concat_ws('|', 'lines', row_key)) END AS lines_fk,
               CASE WHEN lang <> '{X.NO_CLAUSES}' THEN md5(concat_ws('|', 'clauses', row_key)) END AS clauses_fk,
               root_key
        FROM docs
    )"""


DOC_SQL = doc_sql()

# Columns of the audit header with the SQL that gives them from the roots.
HEADER_COLUMNS = {
    "cdlz_header_record_hash_b64": "to_base64(recordHash)",
    "cdlz_header_data_feed_id": "dataFeedId",
    "cdlz_header_collect_data_feed_task_id": "collectDataFeedTaskId",
    "cdlz_header_ingest_data_feed_task_id": "ingestDataFeedTaskId",
    "cdlz_header_collection_date": "collectionDate",
    "cdlz_header_ingest_date_time": "ingestDateTime",
    "cdlz_header_data_format": "dataFormat",
    "cdlz_header_source_filename": "sourceFilename",
    "cdlz_header_source_zip_archive": "nullif(sourceZipArchive, '')",
}


def row_digest(columns) -> str:
    """md5 over the columns, NULLs marked; the same text in Spark and in the checking SQL."""
    shown = ", ".join(f"coalesce(CAST({c} AS {{text}}), '~')" for c in columns)
    return f"md5(concat_ws('|', {shown}))"


def _flat(spark: SparkSession, sf: str, table: str, batch: str | None = None) -> DataFrame:
    """One table of the document tree, from a narrow scan of the landed documents."""
    tree = X.document_tree()
    docs = scan(spark, X.landed_documents(spark, sf), tree.read_schema(table, X.DOCUMENT_SCHEMA))
    return flatten(docs, tree, table, batch=batch)


@query("flatten_root", DOC_SQL + "SELECT * REPLACE (to_base64(recordHash) AS recordHash) FROM roots")
def flatten_root(spark: SparkSession, sf: str) -> DataFrame:
    rows = _flat(spark, sf, "document")
    return rows.withColumn("recordHash", F.base64("recordHash"))


@query(
    "flatten_child",
    DOC_SQL
    + """SELECT document_id, CAST(pos AS INT) AS pos, line, length(line) AS line_chars, words_fk, root_key
         FROM line_rows""",
)
def flatten_child(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(spark, sf, "lines")


@query(
    "flatten_second_branch",
    DOC_SQL + "SELECT document_id, CAST(pos AS INT) AS pos, clause, root_key FROM clauses",
)
def flatten_second_branch(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(spark, sf, "clauses")


@query(
    "flatten_grandchild",
    DOC_SQL + "SELECT lines_id, CAST(pos AS INT) AS pos, word, root_key FROM words",
)
def flatten_grandchild(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(spark, sf, "words")


@query(
    "flatten_links",
    DOC_SQL
    + """
    SELECT 'lines' AS child, (SELECT count(*) FROM lines) AS child_rows,
           (SELECT count(*) FROM lines) AS linked_rows,
           (SELECT count(DISTINCT root_key) FROM lines) AS trees, 'run-1' AS batch
    UNION ALL
    SELECT 'words', (SELECT count(*) FROM words), (SELECT count(*) FROM words),
           (SELECT count(DISTINCT root_key) FROM words), 'run-1'
    UNION ALL
    SELECT 'clauses', (SELECT count(*) FROM clauses), (SELECT count(*) FROM clauses),
           (SELECT count(DISTINCT root_key) FROM clauses), 'run-1'""",
)
def flatten_links(spark: SparkSession, sf: str) -> DataFrame:
    """Child rows, those whose parent holds the same link, tree key and batch, and the trees."""
    tree = X.document_tree()
    tables = {t: _flat(spark, sf, t, X.RUN_ID) for t in tree.tables}
    parts = []
    for child in tree.tables[1:]:
        parent = tree.parent(child)
        links = tables[parent].select(
            F.col(f"{child}_fk").alias(f"{parent}_id"),
            F.col(ROOT_KEY).alias("parent_root"),
            F.col(BATCH_ID).alias("parent_batch"),
        )
        # Children are counted per link before the join: a row per line is joined and sorted, not one per word.
        counted = tables[child].groupBy(f"{parent}_id", ROOT_KEY, BATCH_ID).agg(F.count(F.lit(1)).alias("n"))
        joined = counted.join(links, f"{parent}_id", "left")
        linked = (F.col("parent_root") == F.col(ROOT_KEY)) & (F.col("parent_batch") == F.col(BATCH_ID))
        # Partial counts per tree keep a large document from gathering in one task; a greatest
        # batch beside them would make Spark sort the joined rows, so it is taken per tree afterwards.
        per_batch = joined.groupBy(ROOT_KEY, BATCH_ID).agg(
            F.sum("n").alias("n"), F.sum(F.when(linked, F.col("n")).otherwise(0)).alias("linked")
        )
        per_tree = per_batch.groupBy(ROOT_KEY).agg(
            F.sum("n").alias("n"), F.sum("linked").alias("linked"), F.max(BATCH_ID).alias("batch")
        )
        parts.append(
            per_tree.agg(
                F.sum("n").alias("child_rows"),
                F.sum("linked").alias("linked_rows"),
                F.count(F.lit(1)).alias("trees"),
                F.max("batch").alias("batch"),
            ).select(F.lit(child).alias("child"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


@query("flatten_rejects", "SELECT source, count(*) AS rejected FROM documents WHERE lang = 'fr' GROUP BY source")
def flatten_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a natural key are set apart; here those of one language."""
    docs = X.documents(spark, sf)
    key = F.when(F.col("body.lang") != "fr", F.col("body.doc_id"))
    docs = docs.withColumn("body", F.col("body").withField("doc_id", key))
    lost = rejects(docs, X.document_tree())
    return lost.groupBy(F.col("body.source").alias("source")).agg(F.count(F.lit(1)).alias("rejected"))


def _nominal_digest(name: str, expected: bool) -> str:
    """md5 of all scalar columns of a row: as read, or as the text it was cut from gives them."""
    parts, first = [], True
    for i, f in enumerate(nominal.table_schema(name).fields):
        if isinstance(f.dataType, T.ArrayType):
            continue
        value = f"'{i}:' || length(x)"
        if first:
            value = "CAST(doc_id AS VARCHAR)" if name == nominal.ROOT else "x"
        parts.append(value if expected else f"`{f.name}`")
        first = False
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def _nominal_sql() -> str:
    """Row counts and checksums of the 19 tables, each cut from the text of its parent."""
    tree = nominal.tree()
    ctes, selects = [], []
    for name in tree.tables:
        if name == nominal.ROOT:
            ctes.append(f"{name}_t AS (SELECT doc_id, text AS x FROM documents)")
        else:
            cut = X.NOMINAL_CUTS[name].replace("\n", "' || chr(10) || '")
            ctes.append(
                f"{name}_t AS (SELECT doc_id, unnest(string_split(x, '{cut}')) AS x FROM {tree.parent(name)}_t)"
            )
        selects.append(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, count(DISTINCT doc_id) AS trees, "
            f"count(*) * {len(tree.children(name))} AS links, "
            f"CAST(sum(('0x' || substr({_nominal_digest(name, True)}, 1, 8))::BIGINT) AS BIGINT) AS checksum FROM {name}_t"
        )
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(selects)}"


@query("flatten_nominal", _nominal_sql())
def flatten_nominal(spark: SparkSession, sf: str) -> DataFrame:
    """All 19 tables of the nominal feed, each from its own narrow scan of the landed files."""
    path = X.landed_nominal(spark, sf)
    tree, schema = nominal.tree(), nominal.document_schema()
    tables = flatten_from(lambda s, is_root: scan(spark, path, s), tree, schema)
    parts = []
    for name in tree.tables:
        rows = tables[name]
        checksum = F.conv(F.substring(F.expr(_nominal_digest(name, False)), 1, 8), 16, 10).cast("bigint")
        links = [F.count(c) for c in tree.links(name)]
        counted = rows.groupBy(ROOT_KEY).agg(
            F.count(F.lit(1)).alias("n"),
            (reduce(lambda a, b: a + b, links) if links else F.lit(0).cast("bigint")).alias("k"),
            F.sum(checksum).alias("c"),
        )
        parts.append(
            counted.agg(
                F.sum("n").alias("row_count"),
                F.count(F.lit(1)).alias("trees"),
                F.sum("k").alias("links"),
                F.sum("c").cast("bigint").alias("checksum"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


@query(
    "backfill_columns",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_comment,
           CAST(NULL AS VARCHAR) AS o_shippriority FROM orders""",
)
def backfill_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Prefixed columns are stripped; absent ones are added, but not one that differs in case."""
    orders = X.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order.o_orderkey"),
        F.col("o_custkey").alias("order.customer.o_custkey"),
        F.col("o_orderstatus"),
    )
    declared = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("O_CUSTKEY", T.LongType()),
            T.StructField("o_comment", T.StringType()),
            T.StructField("o_shippriority", T.StringType()),
        ]
    )
    return columns.backfill(columns.strip_prefixes(orders), declared)


@query(
    "project_sql",
    """
    SELECT event_id, upper(event_type) AS kind, round(value, 2) AS amount, 'run-1' AS job_run_id
    FROM events WHERE value > 10""",
)
def project_sql(spark: SparkSession, sf: str) -> DataFrame:
    """A registered projection over a registered view, after a feed's own transform."""
    registry = Projections(
        {
            "shop_event": lambda run_id: [
                "event_id",
                "upper(event_type) AS kind",
                "round(value, 2) AS amount",
                f"'{run_id}' AS job_run_id",
            ]
        },
        aliases={"shopnew_": "shop_"},
    )
    events = X.table(spark, sf, "events").transform(lambda frame: frame.where("value > 10"))
    select = ", ".join(registry.select_list("shopnew_event", X.RUN_ID))
    return project_view(spark, events, "event", select)


def _projections() -> Projections:
    return Projections(
        {
            "text_feed_document": lambda run_id: [
                "doc_id",
                "upper(lang) AS language",
                "n_chars",
                f"'{run_id}' AS job_run_id",
            ],
            "text_feed_lines": ["pos AS line_no", "line", "line_chars"],
            "text_feed_words": ["pos AS word_no", "lower(word) AS word"],
            "text_feed_clauses": ["pos AS clause_no", "clause"],
        }
    )


PROJECTED = {
    "document": [*HEADER_COLUMNS, "doc_id", "language", "n_chars", "job_run_id", "lines_fk", "clauses_fk"],
    "lines": ["document_id", "line_no", "line", "line_chars", "words_fk"],
    "words": ["lines_id", "word_no", "word"],
    "clauses": ["document_id", "clause_no", "clause"],
}


def _projected_sql() -> str:
    """Every projected table in SQL, a digest per row."""
    known = {**HEADER_COLUMNS, "language": "upper(lang)", "job_run_id": "'run-1'", "word": "lower(word)"}
    known |= {"line_no": "pos", "word_no": "pos", "clause_no": "pos", "line_chars": "length(line)"}
    sources = {"document": "roots", "lines": "line_rows", "words": "words", "clauses": "clauses"}
    parts = [
        f"SELECT '{t}' AS table_name, root_key, {row_digest([known.get(c, c) for c in PROJECTED[t]])} AS content FROM {source}"
        for t, source in sources.items()
    ]
    return " UNION ALL ".join(parts).replace("{text}", "VARCHAR")


@query("project_flattened", DOC_SQL + _projected_sql())
def project_flattened(spark: SparkSession, sf: str) -> DataFrame:
    """Every projected table; the header is on the root only."""
    tree = X.document_tree()
    docs = X.documents(spark, sf).withColumn(SOURCE_FILE, F.lit("landed"))
    tables = {t: flatten(docs, tree, t, (SOURCE_FILE,) if t == "document" else ()) for t in tree.tables}
    shaped = project_tree(tables, tree, _projections(), "text_feed", X.RUN_ID, X.AS_OF)
    assert not [c for t in tree.tables[1:] for c in shaped[t].columns if c.startswith("cdlz_")]
    parts = [
        shaped[t].select(
            F.lit(t).alias("table_name"),
            ROOT_KEY,
            F.expr(row_digest(columns).replace("{text}", "STRING")).alias("content"),
        )
        for t, columns in PROJECTED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


HEADER_SQL = """
    SELECT to_base64(unhex(sha256(text))) AS cdlz_header_record_hash_b64, source AS cdlz_header_data_feed_id,
           'collect-' || lang AS cdlz_header_collect_data_feed_task_id,
           'ingest-' || lang AS cdlz_header_ingest_data_feed_task_id,
           '2024-02-01' AS cdlz_header_collection_date, '2024-02-01T00:00:00Z' AS cdlz_header_ingest_date_time,
           'text' AS cdlz_header_data_format, source || '/' || doc_id AS cdlz_header_source_filename,
           {archive} AS cdlz_header_source_zip_archive,
           true AS loaded_as_of, true AS has_file, doc_id, 'run-1' AS job_run_id
    FROM (""" + TEXTS_SQL + ")"
ARCHIVE_SQL = "CASE lang WHEN 'en' THEN '' WHEN 'fr' THEN source || '.zip' END"


def show_volatile(frame: DataFrame) -> DataFrame:
    """Flags for the load time and the input file, whose name differs per run."""
    return frame.select(
        *[c for c in frame.columns if c not in ("glue_timestamp", "input_filename")],
        (F.col("glue_timestamp") == F.lit(X.AS_OF.replace(tzinfo=timezone.utc))).alias("loaded_as_of"),
        F.col("input_filename").endswith(".parquet").alias("has_file"),
    )


def _landed_documents(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, X.landed_documents(spark, sf), X.DOCUMENT_SCHEMA, source_file=True)


@query("audit_header_nested", HEADER_SQL.replace("{archive}", ARCHIVE_SQL))
def audit_header_nested(spark: SparkSession, sf: str) -> DataFrame:
    docs = _landed_documents(spark, sf)
    select = ["body.doc_id AS doc_id", f"'{X.RUN_ID}' AS job_run_id"]
    return show_volatile(project(docs, select, header="nested", as_of=X.AS_OF))


@query("audit_header_flat", HEADER_SQL.replace("{archive}", f"nullif({ARCHIVE_SQL}, '')"))
def audit_header_flat(spark: SparkSession, sf: str) -> DataFrame:
    docs = flatten(_landed_documents(spark, sf), X.document_tree(), "document", (SOURCE_FILE,))
    rows = docs.select(*audit_header(True, X.AS_OF), "doc_id", F.lit(X.RUN_ID).alias("job_run_id"))
    return show_volatile(rows)


BUSINESS_SQL = "text, lang, source, n_chars"


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "documents").select("text", "lang", "source", "n_chars")


@query(
    "duplicate_rows",
    f"""
    SELECT {BUSINESS_SQL} FROM documents
    QUALIFY count(*) OVER (PARTITION BY {BUSINESS_SQL}) > 1
    UNION ALL
    SELECT a.*
    FROM (SELECT user_id::VARCHAR AS text, event_type AS lang, NULL AS source, -1 AS n_chars FROM events) a
    QUALIFY count(*) OVER (PARTITION BY text, lang) > 1""",
)
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All copies of repeated rows, in texts and in the user/type pairs of the events (with NULLs)."""
    pairs = X.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("text"),
        F.col("event_type").alias("lang"),
        F.lit(None).cast("string").alias("source"),
        F.lit(-1).cast("bigint").alias("n_chars"),
    )
    texts = quality.duplicate_rows(_texts(spark, sf))
    return texts.unionByName(quality.duplicate_rows(pairs))


@query(
    "duplicate_groups",
    """
    SELECT user_id, event_type, count(*) AS dup_count FROM events
    GROUP BY user_id, event_type HAVING count(*) > 1""",
)
def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_groups(X.table(spark, sf, "events").select("user_id", "event_type"))


NESTED_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("lines", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("clauses", T.MapType(T.StringType(), T.StructType([T.StructField("clause", T.StringType())]))),
    ]
)


def _nested(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A table of documents that hold words in lines (an array of arrays) and clauses by number (a map)."""
    pieces = F.split("text", ", ")
    numbers = F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.lpad(i.cast("string"), 6, "0"))
    docs = X.table(spark, sf, "documents").select(
        "doc_id",
        "lang",
        F.transform(F.split("text", "\n"), lambda line: F.split(line, " ")).alias("lines"),
        F.map_from_arrays(numbers, F.transform(pieces, lambda clause: F.struct(clause.alias("clause")))).alias("clauses"),
    )
    path = X.scratch_dir(spark, "nested")
    docs.write.parquet(path)
    tree = Tree.from_schema("document", "doc_id", NESTED_SCHEMA)
    return flatten(spark.read.schema(tree.read_schema(table, NESTED_SCHEMA)).parquet(path), tree, table)


def _nested_sql(select: str) -> str:
    return f"""
    WITH docs AS (SELECT *, md5(concat_ws('|', 'document', doc_id)) AS root_key FROM documents),
    line_rows AS (
        SELECT root_key, md5(concat_ws('|', 'lines', root_key)) AS document_id,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, unnest(string_split(text, chr(10))) AS line
        FROM docs),
    lines AS (
        SELECT *, md5(concat_ws('|', 'lines_val', md5(concat_ws('|', document_id, pos)))) AS lines_val_fk FROM line_rows)
    {select}"""


@query("flatten_inner_arrays", _nested_sql("""
    SELECT lines_val_fk AS lines_id, CAST(generate_subscripts(string_split(line, ' '), 1) - 1 AS INT) AS pos,
           unnest(string_split(line, ' ')) AS val, root_key FROM lines"""))
def flatten_inner_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Elements of arrays inside arrays, linked to the array that holds them."""
    return _nested(spark, sf, "lines_val")


@query("flatten_outer_arrays", _nested_sql("SELECT document_id, CAST(pos AS INT) AS pos, lines_val_fk, root_key FROM lines"))
def flatten_outer_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """The arrays in between have a row each, and a link."""
    return _nested(spark, sf, "lines")


@query("flatten_map", _nested_sql("""
    SELECT md5(concat_ws('|', 'clauses', root_key)) AS document_id,
           CAST(generate_subscripts(string_split(text, ', '), 1) - 1 AS INT) AS pos,
           lpad(CAST(generate_subscripts(string_split(text, ', '), 1) AS VARCHAR), 6, '0') AS key,
           unnest(string_split(text, ', ')) AS clause, root_key
    FROM docs"""))
def flatten_map(spark: SparkSession, sf: str) -> DataFrame:
    """The entries of a map as rows, numbered by their keys."""
    return _nested(spark, sf, "clauses")


@query("dedupe_digest_first", f"SELECT DISTINCT {BUSINESS_SQL} FROM documents")
def dedupe_digest_first(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts are shuffled only where a digest repeats."""
    folder = X.scratch_dir(spark, "digests")
    return quality.dedupe_by_digest(_texts(spark, sf), lambda digests: materialise(digests, folder, "repeated")[0])


@query("dedupe_rows", f"SELECT DISTINCT {BUSINESS_SQL} FROM documents")
def dedupe_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dedupe(_texts(spark, sf))


@query(
    "dedupe_before_audit",
    f"SELECT {BUSINESS_SQL}, min(doc_id) AS doc_id FROM documents GROUP BY {BUSINESS_SQL}",
)
def dedupe_before_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Columns that differ between copies of a row do not keep the copies apart."""
    rows = X.table(spark, sf, "documents").select("text", "lang", "source", "n_chars", "doc_id")
    return quality.dedupe(rows, volatile=["doc_id"])


@query(
    "latest_per_key",
    """
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return quality.latest_per_key(X.table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])
