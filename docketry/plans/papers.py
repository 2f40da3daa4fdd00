"""Documents, templates, manifests, flags and lineage on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import arrays, dates, text
from docketry.operators import aggregates, chains, documents, joins, ranking
from docketry.operators.projection import map_lookup
from docketry.plans.joined import ALLOWED_PAIRS, LINE_ORDER, ORDER_RANGE
from docketry.plans.registry import query
from docketry.plans.rows import PRIORITY_BANDS
from docketry.sources.files import table

AS_OF = "1998-12-01"


@query(
    "row_json",
    """SELECT c_custkey, 'party_' || replace(c_mktsegment || '/' || c_custkey, '/', '_') || '.json' AS file_name,
              '{"c_name":"' || c_name || '"' || CASE WHEN c_acctbal > 0 THEN ',"balance":' || CAST(c_acctbal AS DECIMAL(18,2)) ELSE '' END || '}' AS content
       FROM customer""",
)
def row_json(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, aggregates.money("c_acctbal")).alias("balance"), "c_mktsegment"
    )
    key = F.concat_ws("/", "c_mktsegment", F.col("c_custkey").cast("string"))
    return df.select(
        "c_custkey",
        documents.file_name(key, "party_", "json").alias("file_name"),
        documents.row_json(df, exclude=["c_custkey", "c_mktsegment"]).alias("content"),
    )


@query(
    "content_status",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Failure' WHEN o_orderpriority = '5-LOW' THEN 'Failure' ELSE 'Success' END AS status
       FROM orders""",
)
def content_status(spark: SparkSession, sf: str) -> DataFrame:
    content = F.when(F.col("o_orderstatus") == "P", "Failure Error: no body").when(
        F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")
    )
    return table(spark, sf, "orders").select("o_orderkey", documents.content_status(content).alias("status"))


PAGE = (
    "<html><h1>Order {{key}}</h1><p class=\"day\">{{day}}</p><input type=\"checkbox\" {{open}}>"
    "<p>{{note}}</p><table>"
)
PAGE_END = "</table></html>"
PAGE_ROW = "<tr><td>{{line}}</td><td>{{flag}}</td><td>{{day}}</td></tr>"


@query(
    "render_template",
    """SELECT o_orderkey, coalesce(part, 0) AS part,
              CASE WHEN coalesce(part, 0) = 0 THEN '<html><h1>Order ' || o_orderkey || '</h1><p class="day">' || strftime(o_orderdate, '%d/%m/%Y') || '</p><input type="checkbox" '
              || CASE WHEN o_orderstatus = 'O' THEN 'checked' ELSE '' END || '><p>&lt;' || o_orderpriority || '&gt; &amp; &quot;' || o_orderstatus
              || '&quot;</p><table>' ELSE '' END || coalesce(rows, '')
              || CASE WHEN part IS NOT DISTINCT FROM max(part) OVER (PARTITION BY o_orderkey) THEN '</table></html>' ELSE '' END AS page
       FROM orders LEFT JOIN (
         SELECT l_orderkey, (rn - 1) // 4 AS part,
                string_agg('<tr><td>' || l_linenumber || '</td><td>' || l_returnflag || '</td><td>' || strftime(l_shipdate, '%Y-%m-%d') || '</td></tr>', '' ORDER BY rn) AS rows
         FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
         GROUP BY 1, 2) ON l_orderkey = o_orderkey""",
)
def render_template(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents.render_children(
        table(spark, sf, "lineitem"),
        ["l_orderkey"],
        PAGE_ROW,
        {"line": F.col("l_linenumber"), "flag": F.col("l_returnflag"), "day": F.date_format("l_shipdate", "yyyy-MM-dd")},
        "rows",
        LINE_ORDER,
        F.to_date("l_shipdate"),
        raw=["line", "day"],
        size=4,
    )
    orders = table(spark, sf, "orders").join(rows, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    note = F.concat(F.lit("<"), "o_orderpriority", F.lit('> & "'), "o_orderstatus", F.lit('"'))
    head = documents.render(
        PAGE,
        {
            "key": F.col("o_orderkey"),
            "day": F.date_format("o_orderdate", "dd/MM/yyyy"),
            "open": documents.checked(F.col("o_orderstatus") == "O"),
            "note": note,
        },
        raw=["key", "day", "open"],
    )
    page = documents.fragment_page(head, F.col("rows"), F.lit(PAGE_END))
    return orders.select("o_orderkey", F.coalesce("part", F.lit(0)).alias("part"), page.alias("page"))


_MANIFEST_SQL = """'{"operation":"create_record","relation_id":"' || o_orderkey || '","record_metadata":{"publisher":"docketry","record_class":"'
   || o_orderstatus || '","event_date":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '","bf_001":"'
   || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END || '"}}' || chr(10)
   || '{"operation":"upload_new_file","relation_id":"' || o_orderkey || '","file_metadata":{"publisher":"docketry","dz_file_name":"order_' || o_orderkey || '.html","file_tag":"html"}}' || chr(10)
   || '{"operation":"upload_new_file","relation_id":"' || o_orderkey || '","file_metadata":{"publisher":"docketry","dz_file_name":"order_' || o_orderkey || '.json","file_tag":"json"}}'"""


def _manifest():
    return documents.manifest_lines(
        F.col("o_orderkey"),
        {
            "record_class": F.col("o_orderstatus"),
            "event_date": dates.iso_z(F.col("o_orderdate")),
            "bf_001": F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")),
        },
        "docketry",
        "order_",
    )


@query("manifest_record", f"SELECT o_orderkey, {_MANIFEST_SQL} AS manifest FROM orders")
def manifest_record(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", _manifest().alias("manifest"))


@query(
    "manifest_batch",
    f"""SELECT batch_id, count(*) AS records, string_agg(m, chr(10) ORDER BY o_orderkey) AS manifest FROM (
          SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 250 + 1 AS batch_id, {_MANIFEST_SQL} AS m FROM orders)
        GROUP BY 1""",
)
def manifest_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered first on the narrow key columns; the text is built after the sort."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    batches = ranking.batch(orders, ["o_orderkey"], ORDER_RANGE, 250).withColumn("m", _manifest())
    return documents.manifest_batches(batches, "batch_id", "o_orderkey", "m")


@query(
    "archive_metadata",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
                  FROM lineitem),
            p AS (SELECT l_orderkey, max(l_shipdate) FILTER (rn = 1) AS latest, max(l_shipdate) FILTER (rn = 2) AS prev,
                         max(l_returnflag) FILTER (rn = 1) AS flag, max(l_linestatus) FILTER (rn = 1) AS status
                  FROM r GROUP BY 1)
       SELECT o_orderkey AS client_identifier, 'GBR' AS region, o_orderstatus AS record_class,
              strftime(CASE WHEN (flag, status) IN (('R','F'), ('A','F'), ('N','O')) THEN latest
                            WHEN flag = 'R' THEN coalesce(prev, TIMESTAMP '1998-12-01') ELSE TIMESTAMP '1998-12-01' END,
                       '%Y-%m-%dT%H:%M:%SZ') AS event_date
       FROM orders LEFT JOIN p ON l_orderkey = o_orderkey""",
)
def archive_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Retention date: the latest decision for valid (status, outcome) pairs, else the one before it,
    else the date of the run."""
    last = ranking.top_n_pivot(
        table(spark, sf, "lineitem"), ["l_orderkey"], LINE_ORDER,
        {"latest": ("l_shipdate", 1), "prev": ("l_shipdate", 2), "flag": ("l_returnflag", 1), "status": ("l_linestatus", 1)},
    )
    allowed = spark.createDataFrame(ALLOWED_PAIRS, "flag string, status string")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(
        last, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    run = F.lit(AS_OF).cast("timestamp_ntz")
    event = F.when(F.col("ok"), F.col("latest")).when(F.col("flag") == "R", F.coalesce("prev", run)).otherwise(run)
    return joins.in_pairs(orders, ["flag", "status"], allowed, "ok").select(
        F.col("o_orderkey").alias("client_identifier"),
        F.lit("GBR").alias("region"),
        F.col("o_orderstatus").alias("record_class"),
        dates.iso_z(event).alias("event_date"),
    )


def _flags(key, as_of=AS_OF):
    return arrays.flag_array(
        [
            (F.col("o_orderpriority") == "1-URGENT", arrays.flag(key, "Urgent", "PF0001", None, "Yes", as_of)),
            (F.col("o_totalprice") > 300000, arrays.flag(key, "Large", "CF0002", "checked", "No", as_of)),
            (F.col("o_orderstatus") == "P", arrays.flag(key, "Pending", "CF0003", None, "No", as_of)),
        ]
    )


_FLAG_SQL = """CASE WHEN o_orderpriority = '1-URGENT' THEN 'PF0001' END, CASE WHEN o_totalprice > 300000 THEN 'CF0002' END,
               CASE WHEN o_orderstatus = 'P' THEN 'CF0003' END"""


@query(
    "flag_array",
    f"""SELECT o_orderkey, nullif(concat_ws(',', {_FLAG_SQL}), '') AS codes,
               CASE WHEN o_orderpriority = '1-URGENT' THEN sha256(o_orderkey || '|PF0001|Urgent')
                    WHEN o_totalprice > 300000 THEN sha256(o_orderkey || '|CF0002|Large')
                    WHEN o_orderstatus = 'P' THEN sha256(o_orderkey || '|CF0003|Pending') END AS first_id
        FROM orders""",
)
def flag_array(spark: SparkSession, sf: str) -> DataFrame:
    flagged = table(spark, sf, "orders").select("o_orderkey", _flags(F.col("o_orderkey")).alias("flags"))
    return flagged.select(
        "o_orderkey",
        F.array_join(F.transform("flags", lambda f: f["value"]["flagCode"]), ",").alias("codes"),
        F.col("flags")[0]["id"].alias("first_id"),
    )


@query(
    "append_flags",
    f"""SELECT o_orderkey, concat_ws(',', {_FLAG_SQL}, CASE WHEN returned THEN 'RA0004:spoken' END) AS codes
        FROM orders LEFT JOIN (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def append_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Existing flags get the wider struct of the new ones before both are joined."""
    wide = {"flagCode": "string", "status": "string", "subTypeKey": "string"}
    returned = aggregates.group_flag(
        table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], F.col("l_returnflag") == "R", "returned"
    )
    df = joins.assemble(table(spark, sf, "orders").withColumn("flags", _flags(F.col("o_orderkey"))), [returned], "o_orderkey")
    existing = F.transform("flags", lambda f: arrays.align(f["value"], wide, ["flagCode", "status"]))
    added = F.array_compact(
        F.array(
            F.when(
                F.col("returned"),
                F.struct(F.lit("RA0004").alias("flagCode"), F.lit("Active").alias("status"), F.lit("spoken").alias("subTypeKey")),
            )
        )
    )
    empty = F.filter(added, lambda f: F.lit(False))
    merged = F.concat(F.coalesce(existing, empty), added)
    return df.select(
        "o_orderkey",
        F.array_join(F.transform(merged, lambda f: F.concat_ws(":", f["flagCode"], f["subTypeKey"])), ",").alias("codes"),
    )


@query(
    "field_lineage",
    """SELECT o_orderkey, 'band' AS field, 'o_orderpriority' AS input_fields, '{"o_orderpriority":"' || o_orderpriority || '"}' AS input_values,
              CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'normal' END AS value,
              'yes' AS transformation FROM orders
       UNION ALL
       SELECT o_orderkey, 'o_orderstatus', 'o_orderstatus,o_custkey', '{"o_orderstatus":"' || o_orderstatus || '","o_custkey":"' || o_custkey || '"}',
              o_orderstatus, 'no' FROM orders""",
)
def field_lineage(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").withColumn("band", map_lookup(F.col("o_orderpriority"), PRIORITY_BANDS))
    return documents.lineage(
        df, "o_orderkey", {"band": (["o_orderpriority"], True), "o_orderstatus": (["o_orderstatus", "o_custkey"], False)}
    )


@query(
    "inject_json",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '{"k": 1' WHEN event_type = 'view' THEN props
                             ELSE '{"caseNotes":[{"id":"1","user":' || user_id || '}],"k":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}' END AS document
       FROM events""",
)
def inject_json(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that do not parse, and records without a note, stay as they are."""
    note = F.when(F.col("event_type") != "view", F.array(F.struct(F.lit("1").alias("id"), F.col("user_id").alias("user"))))
    document = F.when(F.col("event_type") == "error", '{"k": 1').otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", documents.inject_json(document, "caseNotes", note).alias("document"))


@query(
    "banner_flags",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '*ORAL*' WHEN '2-HIGH' THEN '*PAPER*' ELSE '     ' END
              || CASE WHEN o_orderstatus IN ('O', 'P') THEN '*DET*' ELSE '    ' END AS flag1,
              CASE WHEN o_totalprice > 300000 THEN '*CAM*' ELSE '' END || CASE WHEN o_orderstatus = 'P' THEN '*FEE DUE*' ELSE '' END AS flag2
       FROM orders""",
)
def banner_flags(spark: SparkSession, sf: str) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(
            F.when(priority == "1-URGENT", "*ORAL*").when(priority == "2-HIGH", "*PAPER*").otherwise("     "),
            F.when(status.isin("O", "P"), "*DET*").otherwise("    "),
        ).alias("flag1"),
        F.concat(
            F.when(F.col("o_totalprice") > 300000, "*CAM*").otherwise(""), F.when(status == "P", "*FEE DUE*").otherwise("")
        ).alias("flag2"),
    )


@query(
    "parent_child",
    """SELECT c.o_orderkey, p.o_orderstatus AS parent_o_orderstatus, p.o_orderpriority AS parent_o_orderpriority
       FROM orders c LEFT JOIN orders p ON p.o_orderkey = CASE WHEN c.o_orderstatus = 'P' THEN c.o_orderkey - 1 END""",
)
def parent_child(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").withColumn("parent_id", F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") - 1))
    linked = documents.parent_child(df, "o_orderkey", "parent_id", ["o_orderstatus", "o_orderpriority"])
    return linked.select("o_orderkey", "parent_o_orderstatus", "parent_o_orderpriority")


_ADJOURNED = "CASE WHEN o_orderkey % 50 = 7 THEN o_orderkey + 1 WHEN o_orderkey % 50 = 8 THEN o_orderkey - 1 WHEN o_orderkey % 3 = 0 THEN 11 WHEN o_orderkey BETWEEN 600 AND 900 THEN o_orderkey - 3 WHEN o_orderkey % 10 <> 0 THEN o_orderkey - 1 END"


@query(
    "parent_chains",
    f"""WITH RECURSIVE t AS (SELECT o_orderkey, o_orderstatus, {_ADJOURNED} AS parent FROM orders),
         r AS (SELECT o_orderkey, o_orderkey AS root, CAST(0 AS BIGINT) AS depth FROM t WHERE parent IS NULL OR parent NOT IN (SELECT o_orderkey FROM t)
               UNION ALL SELECT t.o_orderkey, r.root, r.depth + 1 FROM t JOIN r ON t.parent = r.o_orderkey)
       SELECT t.o_orderkey, r.depth, r.root IS NULL AS in_loop, x.o_orderstatus AS root_o_orderstatus
       FROM t LEFT JOIN r ON r.o_orderkey = t.o_orderkey LEFT JOIN orders x ON x.o_orderkey = r.root""",
)
def parent_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Adjournments of adjournments: the fields of the first one, the depth, and the loops; a third of the rows have one parent."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.expr(_ADJOURNED).alias("parent"))
    return chains.with_root(df, "o_orderkey", "parent", ["o_orderstatus"]).select("o_orderkey", "depth", "in_loop", "root_o_orderstatus")


@query(
    "update_nested",
    """SELECT l_orderkey, (rn - 1) // 3 AS part,
              string_agg(lower(l_returnflag) || CASE WHEN l_linestatus = 'F' THEN 'closed' ELSE l_linestatus END, ',' ORDER BY rn) AS lines
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
       GROUP BY 1, 2""",
)
def update_nested(spark: SparkSession, sf: str) -> DataFrame:
    nested = aggregates.nest(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"], "lines", LINE_ORDER, F.to_date("l_shipdate"), 3)
    changed = arrays.update_each(
        F.col("lines"),
        {
            "l_returnflag": lambda i: F.lower(i["l_returnflag"]),
            "l_linestatus": lambda i: F.when(i["l_linestatus"] == "F", "closed").otherwise(i["l_linestatus"]),
        },
    )
    shown = F.transform(changed, lambda i: F.concat(i["l_returnflag"], i["l_linestatus"]))
    return nested.select("l_orderkey", "part", F.array_join(shown, ",").alias("lines"))


@query(
    "text_block",
    """SELECT c_custkey, 'Listed details:' || chr(10) || 'Name: ' || c_name || ' ' || c_mktsegment || CASE WHEN c_acctbal > 5000 THEN ' (Gold)' ELSE '' END
              || chr(10) || 'Segment: ' || c_mktsegment || chr(10) || 'Balance: '
              || CASE WHEN c_acctbal > 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) ELSE 'N/A' END AS block
       FROM customer""",
)
def text_block(spark: SparkSession, sf: str) -> DataFrame:
    title = F.when(F.col("c_acctbal") > 5000, "Gold").otherwise("")
    block = text.labelled_block(
        "Listed details:",
        [
            ("Name", text.person_name(F.col("c_name"), F.col("c_mktsegment"), title)),
            ("Segment", F.col("c_mktsegment")),
            ("Balance", F.when(F.col("c_acctbal") > 0, aggregates.money("c_acctbal"))),
        ],
    )
    return table(spark, sf, "customer").select("c_custkey", block.alias("block"))


@query(
    "pair_fill",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS received, strftime(o_orderdate, '%Y-%m-%d') AS deemed,
              CASE o_orderstatus WHEN 'F' THEN 'centre' WHEN 'O' THEN o_orderpriority
                   ELSE CASE WHEN o_orderpriority = '1-URGENT' THEN 'centre' ELSE o_orderpriority END END AS address
       FROM orders""",
)
def pair_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Two dates that stand in for each other, and an address chosen by the kind of stay."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    received, deemed = F.when(key % 2 == 0, day), F.when(key % 2 == 1, day)
    centre = F.when((status == "F") | (F.col("o_orderpriority") == "1-URGENT"), "centre")
    address = F.when(status == "F", centre).when(status == "O", F.col("o_orderpriority")).otherwise(
        F.coalesce(centre, F.col("o_orderpriority"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(received, deemed).alias("received"), F.coalesce(deemed, received).alias("deemed"), address.alias("address")
    )
