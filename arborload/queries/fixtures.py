"""Inputs derived from the given tables: documents, linked tables, stages, landing areas.

Everything is derived row by row or by joins; no group of rows is collected into
one document.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.functions import keys as K
from arborload.plans import nominal
from arborload.sources.landing import PARTITIONS
from arborload.sources.scratch import CODEC
from arborload.tree import ROOT_KEY, Tree, id_column, link_column

RUN_ID = "run-1"
AS_OF = datetime(2024, 2, 1, 0, 10)

# Segments of customers that a batch changes, adds copies of and deletes.
CHANGED = "BUILDING"
COPIED = "MACHINERY"
DELETED = "FURNITURE"
NEW_CUSTOMER = 1_000_000_000
NEW_ORDER = 1_000_000_000_000


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new directory name under ``spark.checkpoint.dir``, for the inputs that queries derive.

    Where the setting is absent, a local session uses a temporary folder; a cluster has
    no folder all executors can see, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="arborload-")
    return f"{base.rstrip('/')}/arborload/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- nested documents from the text table ------------------------------------


def _pieces(text: Column, separator: str, element) -> Column:
    return F.transform(F.split(text, separator), element)


def header_struct(key: Column, feed: Column, lang: Column, content: Column) -> Column:
    """Header of a landed document; archives are named, empty or NULL by language."""
    archive = F.when(lang == "en", F.lit("")).when(lang == "fr", F.concat(feed, F.lit(".zip")))
    return F.struct(
        F.unhex(F.sha2(content, 256)).alias("recordHash"),
        feed.alias("dataFeedId"),
        F.concat(F.lit("collect-"), lang).alias("collectDataFeedTaskId"),
        F.concat(F.lit("ingest-"), lang).alias("ingestDataFeedTaskId"),
        F.lit("2024-02-01").alias("collectionDate"),
        F.lit(INGESTED).alias("ingestDateTime"),
        F.lit("text").alias("dataFormat"),
        F.concat_ws("/", feed, key.cast("string")).alias("sourceFilename"),
        archive.alias("sourceZipArchive"),
    )


# Edge rows next to the texts: documents without lines (NULL) and with an empty list of clauses.
NO_LINES, NO_CLAUSES = "none", "empty"
EDGE_DOCUMENT = -1_000_000_000
INGESTED = "2024-02-01T00:00:00Z"


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """All texts, and the edge rows, one per region."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    edges = table(spark, sf, "region").select(
        (F.lit(EDGE_DOCUMENT) - F.col("r_regionkey")).cast("bigint").alias("doc_id"),
        F.col("r_name").alias("text"),
        F.when(F.col("r_regionkey") % 2 == 0, NO_LINES).otherwise(NO_CLAUSES).alias("lang"),
        F.lit("edge").alias("source"),
        F.length("r_name").cast("bigint").alias("n_chars"),
    )
    return table(spark, sf, "documents").select(columns).unionByName(edges)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents_of(texts(spark, sf))


def documents_of(texts: DataFrame) -> DataFrame:
    """One nested document per text: lines that hold words, and clauses."""
    lines = _pieces(
        F.col("text"),
        "\n",
        lambda line: F.struct(
            line.alias("line"),
            F.length(line).cast("bigint").alias("line_chars"),
            _pieces(line, " ", lambda word: F.struct(word.alias("word"))).alias("words"),
        ),
    )
    clauses = _pieces(F.col("text"), ", ", lambda clause: F.struct(clause.alias("clause")))
    body = F.struct(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.when(F.col("lang") != NO_LINES, lines).alias("lines"),
        F.when(F.col("lang") == NO_CLAUSES, F.slice(clauses, 1, 0)).otherwise(clauses).alias("clauses"),
    )
    header = header_struct(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("text"))
    return texts.select(header.alias("header"), body.alias("body"))


DOCUMENT_BODY = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField(
            "lines",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("line", T.StringType()),
                        T.StructField("line_chars", T.LongType()),
                        T.StructField(
                            "words",
                            T.ArrayType(T.StructType([T.StructField("word", T.StringType())])),
                        ),
                    ]
                )
            ),
        ),
        T.StructField(
            "clauses", T.ArrayType(T.StructType([T.StructField("clause", T.StringType())]))
        ),
    ]
)
DOCUMENT_SCHEMA = T.StructType(
    [T.StructField("header", nominal.HEADER), T.StructField("body", DOCUMENT_BODY)]
)


def document_tree() -> Tree:
    return Tree.from_schema("document", "doc_id", DOCUMENT_SCHEMA)


# Separator that cuts the text of a parent row into the rows of a child table.
NOMINAL_CUTS = {
    "occupation": "\n",
    "informationmarker": ", ",
    "caseheader": "\n",
    "operationalinformation": "\n",
    "oiconditions": ", ",
    "offence": ". ",
    "condition": "; ",
    "method": "! ",
    "custody": ". ",
    "bailconditions": ": ",
    "breachofbail": "; ",
    "disposal": " de ",
    "subsequentappearance": " the ",
    "cooffender": " la ",
    "mokeywordlocation": ", ",
    "mokeywordvictim": " and ",
    "periodininstitution": ", ",
    "releasedetails": " of ",
}


def _nominal_struct(name: str, text: str, key: str | None = None) -> str:
    """SQL for one row of a table: its text in the first column, its pieces in the arrays.

    The other columns hold their number and the length of the text.
    """
    parts = []
    first = True
    for i, f in enumerate(nominal.table_schema(name).fields):
        child = f.name.lower()
        if isinstance(f.dataType, T.ArrayType):
            cut = NOMINAL_CUTS[child].replace(".", "[.]").replace("\n", "\\n")
            value = f"transform(split({text}, '{cut}'), {child} -> {_nominal_struct(child, child)})"
        elif first:
            value, first = key or text, False
        else:
            value = f"concat('{i}:', length({text}))"
        parts.append(f"'{f.name}', {value}")
    return f"named_struct({', '.join(parts)})"


def nominal_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as nominal records: every table cuts the text of its parent into pieces."""
    key = F.col("doc_id").cast("string")
    header = header_struct(key, F.col("source"), F.col("lang"), F.col("text"))
    body = F.expr(_nominal_struct(nominal.ROOT, "text", "CAST(doc_id AS STRING)"))
    return table(spark, sf, "documents").select(header.alias("header"), body.alias("body"))


# -- linked tables from the star schema --------------------------------------

STAR = Tree.of(
    "customer",
    "c_custkey",
    {
        "customer": ["orders", "events"],
        "orders": ["lineitem"],
        "lineitem": ["part"],
        "part": ["supplier"],
    },
    keep_repeats=["orders"],
)


def _customer_key(column: str) -> Column:
    return F.expr(K.root_key("customer", column))


def _link(child: str, parent_row: str) -> Column:
    return F.expr(K.link_key(child, parent_row))


def _order_row(column: str) -> str:
    return K.digest("'orders'", column)


ITEM_ROW = K.digest("'lineitem'", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def link_customer(customer: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    """Customers with links to their orders and events; NULL where there are none."""
    some_orders = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    some_events = events.select(F.col("user_id").alias("c_custkey")).distinct()
    root = K.root_key("customer", "c_custkey")

    def link(child: str, flag: str) -> Column:
        return F.when(F.col(flag), _link(child, root)).alias(link_column(child))

    return (
        customer.join(some_orders.withColumn("has_orders", F.lit(True)), "c_custkey", "left")
        .join(some_events.withColumn("has_events", F.lit(True)), "c_custkey", "left")
        .select(
            *customer.columns,
            link("orders", "has_orders"),
            link("events", "has_events"),
            F.expr(root).alias(ROOT_KEY),
        )
    )


def link_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    filled = lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    root = K.root_key("customer", "o_custkey")
    child = F.when(F.col("has_items"), _link("lineitem", _order_row("o_orderkey")))
    return orders.join(filled.withColumn("has_items", F.lit(True)), "o_orderkey", "left").select(
        _link("orders", root).alias(id_column("customer")),
        *orders.columns,
        child.alias(link_column("lineitem")),
        F.expr(root).alias(ROOT_KEY),
    )


def link_lineitem(lineitem: DataFrame, orders: DataFrame | None) -> DataFrame:
    """Line items; the root key needs the order's customer, the links do not."""
    columns = [
        _link("lineitem", _order_row("l_orderkey")).alias(id_column("orders")),
        *lineitem.columns,
        _link("part", ITEM_ROW).alias(link_column("part")),
    ]
    if orders is None:
        return lineitem.select(*columns)
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lineitem.join(owner, "l_orderkey").select(
        *columns, _customer_key("o_custkey").alias(ROOT_KEY)
    )


def link_part(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """The part of every line item, as a child row of the item."""
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        _link("part", ITEM_ROW).alias(id_column("lineitem")),
        *part.columns,
        _link("supplier", ITEM_ROW).alias(link_column("supplier")),
    )


def link_supplier(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    return lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        _link("supplier", ITEM_ROW).alias(id_column("part")), *supplier.columns
    )


def link_events(events: DataFrame) -> DataFrame:
    root = K.root_key("customer", "user_id")
    return events.select(
        _link("events", root).alias(id_column("customer")), *events.columns, F.expr(root).alias(ROOT_KEY)
    )


def star_targets(spark: SparkSession, sf: str, rooted: bool = True) -> dict[str, DataFrame]:
    """The linked tables; ``rooted`` adds the root key to the line items."""
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    lineitem, events = table(spark, sf, "lineitem"), table(spark, sf, "events")
    return {
        "customer": link_customer(customer, orders, events),
        "orders": link_orders(orders, lineitem),
        "lineitem": link_lineitem(lineitem, orders if rooted else None),
        "part": link_part(lineitem, table(spark, sf, "part")),
        "supplier": link_supplier(lineitem, table(spark, sf, "supplier")),
        "events": link_events(events),
    }


# Three levels and two branches, the part of the tree that carries root keys.
ROOTED = Tree.of(
    "customer",
    "c_custkey",
    {"customer": ["orders", "events"], "orders": ["lineitem"]},
    keep_repeats=["orders"],
)


def star_stage(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """A batch: one segment of customers renamed, another copied under new keys.

    Every row comes twice, with the whole subtree of its customer.
    """
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    lineitem, events = table(spark, sf, "lineitem"), table(spark, sf, "events")
    segment = customer.select("c_custkey", "c_mktsegment")

    changed = customer.where(F.col("c_mktsegment") == CHANGED)
    copied = customer.where(F.col("c_mktsegment") == COPIED)
    staged_customer = changed.withColumn("c_name", F.concat("c_name", F.lit("*"))).unionByName(
        copied.withColumn("c_custkey", F.col("c_custkey") + NEW_CUSTOMER)
    )

    def shift(column: str, by: int) -> Column:
        moved = F.when(F.col("c_mktsegment") == COPIED, F.col(column) + by)
        return moved.otherwise(F.col(column)).alias(column)

    batch = F.col("c_mktsegment").isin(CHANGED, COPIED)
    owned = orders.join(segment.where(batch), F.col("o_custkey") == F.col("c_custkey"))
    staged_orders = owned.select(
        shift("o_orderkey", NEW_ORDER),
        shift("o_custkey", NEW_CUSTOMER),
        *[c for c in orders.columns if c not in ("o_orderkey", "o_custkey")],
    )
    owner = owned.select(F.col("o_orderkey").alias("l_orderkey"), "c_mktsegment")
    staged_items = lineitem.join(owner, "l_orderkey").select(
        shift("l_orderkey", NEW_ORDER), *[c for c in lineitem.columns if c != "l_orderkey"]
    )
    staged_events = events.join(
        segment.where(batch), F.col("user_id") == F.col("c_custkey")
    ).select(*[shift(c, NEW_CUSTOMER) if c == "user_id" else c for c in events.columns])

    rows = {
        "customer": link_customer(staged_customer, staged_orders, staged_events),
        "orders": link_orders(staged_orders, staged_items),
        "lineitem": link_lineitem(staged_items, staged_orders),
        "events": link_events(staged_events),
    }
    twice = F.explode(F.array(F.lit(1), F.lit(2)))
    return {t: r.withColumn("copy", twice).drop("copy") for t, r in rows.items()}


def delete_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Delete messages: one segment, unknown keys, customers named twice, NULL keys."""
    customer = table(spark, sf, "customer")
    gone = customer.where(F.col("c_mktsegment") == DELETED).select(F.col("c_custkey").alias("key"))
    again = customer.where((F.col("c_mktsegment") == DELETED) & (F.col("c_acctbal") < 0)).select(
        F.col("c_custkey").alias("key")
    )
    unknown = table(spark, sf, "supplier").select((-1 - F.col("s_suppkey")).alias("key"))
    empty = table(spark, sf, "region").select(F.lit(None).cast("bigint").alias("key"))
    keys = gone.unionByName(again).unionByName(unknown).unionByName(empty)
    return keys.select(F.struct(F.col("key").alias("PNCID")).alias("body"))


# -- landing areas -----------------------------------------------------------


_LANDED: dict[tuple[str, str, str], str] = {}


def landed_at(ts: Column) -> Column:
    """Landing time of an event: its minutes since January, ten to one, from 30 January on.

    A month of events thus lands in three days that cross the end of a month.
    """
    days = F.datediff(ts.cast("date"), F.lit("2024-01-01").cast("date"))
    minutes = days * 1440 + F.hour(ts) * 60 + F.minute(ts)
    start = F.lit("2024-01-30").cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", F.floor(minutes / 10).cast("int"), start)


def landed_events(spark: SparkSession, sf: str) -> tuple[str, T.StructType]:
    """The events as a landing area, written once per application."""
    events = table(spark, sf, "events")
    area = (spark.sparkContext.applicationId, sf, "events")
    if area not in _LANDED:
        path = scratch_dir(spark, "events")
        land(events, landed_at(F.col("ts")), path, spread_by=["event_id"])
        _LANDED[area] = path
    return _LANDED[area], events.schema


def landed_documents(spark: SparkSession, sf: str) -> str:
    """The nested texts as a landing area, written once per application."""
    return _landed_once(spark, sf, "documents", documents)


def landed_nominal(spark: SparkSession, sf: str) -> str:
    """The nominal documents as a landing area, written once per application."""
    return _landed_once(spark, sf, "nominal", nominal_documents)


def _landed_once(spark: SparkSession, sf: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> str:
    area = (spark.sparkContext.applicationId, sf, name)
    if area not in _LANDED:
        path = scratch_dir(spark, name)
        land(build(spark, sf), AS_OF, path)
        _LANDED[area] = path
    return _LANDED[area]


def land(frame: DataFrame, at: Column | datetime, path: str, spread_by: Sequence[str] = ()) -> None:
    """Write rows into year=/month=/day=/hour=/minute= directories.

    Every third hour has a directory, with minutes in steps of 20.  With
    ``spread_by`` rows are ranged by time and those columns, so that a task fills
    few directories and a busy directory is shared by several tasks; without it
    the tasks write what they hold.  Rows that all land at one moment go straight into
    its directory: Spark would sort whole documents by the constant partition columns.
    """
    if isinstance(at, datetime):
        hour, minute = at.hour // 3 * 3 + 2, at.minute // 20 * 20
        folder = f"year={at.year}/month={at.month:02}/day={at.day:02}/hour={hour:02}/minute={minute:02}"
        frame.write.mode("append").parquet(f"{path}/{folder}", compression=CODEC)
        return
    values = [
        F.year(at),
        F.month(at),
        F.dayofmonth(at),
        F.floor(F.hour(at) / 3) * 3 + 2,
        F.floor(F.minute(at) / 20) * 20,
    ]
    padded = [F.lpad(v.cast("string"), 2, "0") for v in values[1:]]
    stamps = [v.alias(p) for p, v in zip(PARTITIONS, [values[0], *padded], strict=True)]
    rows = frame.select("*", *stamps)
    if spread_by:
        rows = rows.repartitionByRange(*PARTITIONS, *spread_by)
    rows.write.mode("append").partitionBy(*PARTITIONS).parquet(path, compression=CODEC)
