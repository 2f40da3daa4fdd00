"""Archive segments: which closed cases go to which archive list, and their retention date."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.cases import codes
from docketry.cases.base import KEY, CaseTables
from docketry.cases.states import (
    DROPPED,
    DROPPED_RECENT,
    FINISHED,
    FINISHED_BEFORE,
    MAIN_OR_DROPPED,
    MAIN_PREFIXES,
    OPEN,
    OVERDUE_PREFIXES,
    SHUT,
    STATE_FIELDS,
    UPPER,
    UPPER_NOW,
    one_of,
)
from docketry.functions import dates
from docketry.operators import aggregates, chains, combine, documents, joins, projection, ranking, skew
from docketry.sources.scratch import materialise

# Unlike the live rules these keep rows whose status or outcome is unknown.
ARCHIVE_VARIANTS = {
    "t": "(Outcome IS NULL OR Outcome NOT IN (38, 111)) AND (CaseStatus IS NULL OR CaseStatus <> 17)",
    "st": "CaseStatus IS NULL OR CaseStatus NOT IN (52, 36)",
    "us": f"CaseStatus IN {UPPER}",
}
UNSURE = "Not sure?"
# Department of cases on hold and of preserved files.
HOLD_DEPARTMENT, PRESERVED_DEPARTMENT = 519, 520


def _plus(row: str, months: int) -> str:
    return f"CAST({row}.DecisionDate AS DATE) + INTERVAL {months} MONTH"


def category_rules(as_of: str) -> list[tuple[str, str]]:
    """Category of a case by tier and age of its last decision at ``as_of``."""
    day = f"DATE '{as_of}'"
    shut_row = {"t": "t.CaseStatus NOT IN (36, 52)", "st": "t.CaseStatus IN (36, 52)"}
    upper_later = {r: f"us.CaseStatus IS NOT NULL AND {c} AND {_plus('us', 60)} >= {_plus(r, 24)}" for r, c in shut_row.items()}
    upper_first = f"{_plus('us', 60)} < {_plus('t', 24)}"
    first = (
        f"(({one_of('ac.CasePrefix', MAIN_PREFIXES)} AND us.CaseStatus IS NULL) OR ({one_of('ac.CasePrefix', MAIN_PREFIXES)} AND us.CaseStatus IS NOT NULL AND {upper_first})"
        f" OR ({DROPPED} AND ac.HOANRef IS NULL) OR {DROPPED_RECENT})"
    )
    live = f"({MAIN_OR_DROPPED} OR {DROPPED_RECENT})"
    before = f"{SHUT} AND {FINISHED_BEFORE}"
    return [
        ("UT Remitted", f"{UPPER_NOW} AND t.Outcome = 86"),
        ("UT Active", f"{UPPER_NOW} AND t.Outcome = 0"),
        ("UT Overdue", f"{one_of('ac.CasePrefix', OVERDUE_PREFIXES)} AND {UPPER_NOW}"),
        ("FT", one_of("ac.CasePrefix", OVERDUE_PREFIXES)),
        ("UT Retained", f"{upper_later['t']} AND {_plus('us', 60)} >= {day}"),
        ("UT Retained", f"{upper_later['st']} AND {_plus('us', 60)} >= {day}"),
        ("UT Overdue", f"{upper_later['t']} AND {_plus('us', 60)} < {day}"),
        ("UT Overdue", f"{upper_later['st']} AND {_plus('us', 60)} < {day}"),
        ("FT Active", f"us.CaseStatus IS NOT NULL AND {OPEN}"),
        ("FT Active", f"{MAIN_OR_DROPPED} AND {OPEN}"),
        ("FT Live", f"{live} AND {FINISHED} AND {_plus('t', 6)} >= {day}"),
        ("FT Live", f"{live} AND {before} AND {_plus('st', 6)} >= {day}"),
        ("FT", f"{first} AND {FINISHED} AND t.DecisionDate IS NOT NULL"),
        ("FT", f"{first} AND {before} AND st.DecisionDate IS NOT NULL"),
        ("FT", "ac.CasePrefix = 'IA' AND t.CaseStatus IN (30, 31)"),
        ("FT", f"{DROPPED} AND ac.HOANRef IS NOT NULL AND us.CaseStatus IS NULL"),
    ]


def decision_rules(as_of: str) -> list[tuple[str, str]]:
    """Kind of case for the list of tribunal decisions."""
    day = f"DATE '{as_of}'"
    main_first = f"(({one_of('ac.CasePrefix', MAIN_PREFIXES)} AND us.CaseStatus IS NULL) OR ({DROPPED} AND ac.HOANRef IS NULL) OR {DROPPED_RECENT})"
    return [
        ("UT Active", f"{UPPER_NOW} AND t.Outcome IN (0, 86)"),
        ("Decision", f"DeptId IN ({HOLD_DEPARTMENT}, {PRESERVED_DEPARTMENT})"),
        ("Decision", one_of("ac.CasePrefix", OVERDUE_PREFIXES)),
        ("FT Active", f"us.CaseStatus IS NOT NULL AND {OPEN}"),
        ("FT Active", f"{MAIN_OR_DROPPED} AND {OPEN}"),
        ("FT Live", f"({MAIN_OR_DROPPED} OR {DROPPED_RECENT}) AND {FINISHED} AND {_plus('t', 6)} >= {day}"),
        ("FT Live", f"{main_first} AND {SHUT} AND {FINISHED_BEFORE} AND {_plus('st', 6)} >= {day}"),
        ("Decision", f"{DROPPED} AND ac.HOANRef IS NULL"),
        ("Decision", f"{DROPPED} AND us.CaseStatus IS NOT NULL"),
        ("Skeleton", f"{DROPPED} AND ac.HOANRef IS NOT NULL"),
    ]


def before_set_aside(statuses: DataFrame) -> DataFrame:
    """The last status before the last set-aside (46)."""
    marks = statuses.filter(F.col("CaseStatus") == 46).groupBy(KEY).agg(F.max("StatusId").alias("_mark"))
    other = statuses.filter(F.col("CaseStatus").isNull() | (F.col("CaseStatus") != 46)).select(KEY, "StatusId", "CaseStatus")
    below = other.join(marks, KEY).filter(F.col("StatusId") < F.col("_mark"))
    return below.groupBy(KEY).agg(F.max(F.struct("StatusId", "CaseStatus")).alias("sa"))


def wide_rows(tables: CaseTables, locations: DataFrame) -> DataFrame:
    """Header, department and the four status rows of each case."""
    picked = tables.statuses.groupBy(KEY).agg(
        *[F.max(F.when(F.expr(c), F.struct("StatusId", *STATE_FIELDS))).alias(n) for n, c in ARCHIVE_VARIANTS.items()]
    )
    cases = tables.header.filter(F.col("CaseType") == 1).select(KEY, F.struct("CasePrefix", "HOANRef").alias("ac"))
    return joins.assemble(cases, [locations.select(KEY, "DeptId"), picked, before_set_aside(tables.statuses)], KEY)


def _cascade(rules: Iterable[tuple[str, str]], default: str) -> Column:
    return projection.first_match([(n, F.expr(c)) for n, c in rules], default)


def categories(rows: DataFrame, as_of: str) -> DataFrame:
    kept = rows.filter(~F.col("DeptId").isin(HOLD_DEPARTMENT, PRESERVED_DEPARTMENT))
    return kept.select(KEY, _cascade(category_rules(as_of), UNSURE).alias("category"))


def skeletons(rows: DataFrame, as_of: str) -> Column:
    """A dropped case that never reached the upper tribunal and is not overdue."""
    dropped = F.expr(DROPPED) & F.col("ac.HOANRef").isNotNull() & F.col("us.CaseStatus").isNull()
    decided = F.col("t.DecisionDate")
    return dropped & (decided.isNull() | ~dates.retention_due(decided, 24, as_of)) & ~F.col("DeptId").isin(HOLD_DEPARTMENT, PRESERVED_DEPARTMENT)


def segments(tables: CaseTables, locations: DataFrame, as_of: str, labels: dict[str, str]) -> DataFrame:
    """Cases per archive list: ``labels`` names the first-tier, upper and preserved list.

    A case may be on several lists; the same entry from two rules appears once.
    """
    rows = wide_rows(tables, locations)
    kept = ~F.col("DeptId").isin(HOLD_DEPARTMENT, PRESERVED_DEPARTMENT)
    category = _cascade(category_rules(as_of), UNSURE)
    lists = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(kept & (category == "FT"), labels["first"]),
                F.when(skeletons(rows, as_of), labels["first"]),
                F.when(kept & category.isin("UT Retained", "UT Overdue"), labels["upper"]),
                F.when(F.col("DeptId") == PRESERVED_DEPARTMENT, labels["preserved"]),
            )
        )
    )
    return rows.select(KEY, F.explode(lists).alias("Segment"))


def decision_list(tables: CaseTables, locations: DataFrame, as_of: str) -> DataFrame:
    """Cases of which only the decision is kept."""
    rows = wide_rows(tables, locations)
    kind = _cascade(decision_rules(as_of), "Decision")
    return rows.filter(kind == "Decision").select(KEY)


HOLD_NOTES = ["%indefinite retention%", "%indefinate retention%"]
DESTROYED_NOTES = ["%destroyed%", "%detroyed%", "%destoyed%", "%distroyed%"]


def bail_segments(
    cases: DataFrame, statuses: DataFrame, locations: DataFrame, history: DataFrame, as_of: str
) -> DataFrame:
    """Bail cases under legal hold, and normal ones decided in the last 24 months.

    Hold notes are reduced to two flags per case before the join, so a long history does not multiply
    the cases. A case with both kinds of notes is on both lists.
    """
    hold = projection.match_any(F.col("Comment"), HOLD_NOTES)
    notes = history.groupBy(KEY).agg(F.bool_or(hold).alias("held"), F.bool_or(~hold).alias("plain"))
    last = statuses.filter(F.col("CaseStatus").isNull() | (F.col("CaseStatus") != 17)).groupBy(KEY).agg(
        F.max(F.struct("StatusId", "DecisionDate")).alias("t")
    )
    here = locations.filter(F.col("DeptId") != HOLD_DEPARTMENT)
    rows = joins.assemble(cases.select(KEY).join(here, KEY), [notes, last], KEY)
    gone = projection.match_any(F.col("Note"), DESTROYED_NOTES)
    old = F.coalesce(dates.retention_due(F.col("t.DecisionDate"), 24, as_of), F.lit(False))
    held = F.coalesce("held", F.lit(False))
    normal = ~gone & ~old & F.coalesce("plain", F.lit(True))
    lists = F.array_compact(F.array(F.when(normal, "Normal Bail"), F.when(held, "BailLegalHold")))
    return rows.select(KEY, F.explode(lists).alias("BaseBailType"))


# What a list of bail cases is called.
BAIL_KINDS = {"Normal Bail": "Bail", "BailLegalHold": "Bail", "ScottishBailsFunds": "Scottish Bail"}


def scottish_funds(listed: DataFrame) -> DataFrame:
    """Cases on the external list of Scottish bails that hold funds; rows without a number do not count."""
    return listed.filter(F.col(KEY).isNotNull()).select(F.btrim(KEY).alias(KEY), F.lit("ScottishBailsFunds").alias("BaseBailType")).distinct()


def bail_details(cases: DataFrame, segments: DataFrame, locations: DataFrame, diary: DataFrame) -> DataFrame:
    """The bail record of each case and list: coded columns as labels, its place, and whether its diary has open entries.

    ``locations`` has centre, department and note of the file, one row per case; ``diary`` Entry and DateCompleted.
    """
    kind = F.lit("Other")
    for name, label in BAIL_KINDS.items():
        kind = F.when(F.col("BaseBailType") == name, label).otherwise(kind)
    still_open = diary.groupBy(KEY).agg(F.bool_or(F.col("Entry").isNotNull() & F.col("DateCompleted").isNull()).alias("_open"))
    place = locations.select(KEY, F.concat_ws(", ", "centre", "department", "note").alias("FileLocation"))
    wide = joins.assemble(segments.join(cases, KEY), [place, still_open], KEY)
    labelled = codes.decode(wide, "bail", "Desc")
    return labelled.withColumns(
        {"BailTypeDesc": kind, "BFEntry": F.when(F.col("_open"), "B/F entries exist").otherwise("")}
    ).drop("_open")


def officers(people: DataFrame, roles: DataFrame, key: str = "AdjudicatorId") -> DataFrame:
    """Officers with any role but the excluded ones (7, 8), or with none."""
    kept = people.select(key).join(roles.select(key, "Role"), key, "left")
    return kept.filter(projection.not_in(F.col("Role"), [7, 8], keep_null=True)).select(key).distinct()


PAGE_HEAD = "<html><h1>{{case}}</h1><p>{{segment}} {{reference}}</p><table>"
PAGE_ROW = "<tr><td>{{day}}</td><td>{{status}}</td><td>{{outcome}}</td></tr>"
PAGE_TAIL = "</table></html>"


def case_documents(cases: DataFrame, statuses: DataFrame, size: int = aggregates.PART) -> DataFrame:
    """The HTML page and the JSON record of each case with its status rows, in parts that join to the documents.

    ``cases`` has CaseNo, Segment and HORef, one row per case. A part holds ``size`` status rows in order, those without
    a date first; head and tail are on the first and last part only. Rows and entries share one rank and one aggregate.
    """
    shown = F.date_format("DateReceived", "yyyy-MM-dd")
    values = {"day": shown, "status": F.col("CaseStatus"), "outcome": F.col("Outcome")}
    entry = F.to_json(F.struct("StatusId", F.col("CaseStatus").alias("status"), F.col("Outcome").alias("outcome"), shown.alias("received")))
    both = {"rows": (documents.render(PAGE_ROW, values, ["day", "status", "outcome"]), ""), "entries": (entry, ",")}
    parts = cases.join(documents.joined_parts(statuses, [KEY], both, ["DateReceived", "StatusId"], F.to_date("DateReceived"), size), KEY, "left")
    head = documents.render(PAGE_HEAD, {"case": F.col(KEY), "segment": F.col("Segment"), "reference": F.col("HORef")})
    record = F.to_json(F.struct(KEY, "Segment", "HORef"))
    # The record stays open for its rows; a later part goes on after a comma.
    opened = F.concat(F.substring(record, F.lit(1), F.length(record) - 1), F.lit(',"statuses":['))
    more = F.when(F.coalesce("first_part", F.lit(True)), F.coalesce("entries", F.lit(""))).otherwise(F.concat(F.lit(","), "entries"))
    return parts.select(
        KEY,
        F.coalesce("part", F.lit(0)).alias("part"),
        documents.fragment_page(head, F.col("rows"), F.lit(PAGE_TAIL)).alias("html"),
        documents.fragment_page(opened, more, F.lit("]}")).alias("json"),
    )


def manifests(cases: DataFrame, publisher: str, prefix: str, size: int = 250) -> DataFrame:
    """Manifests of ``size`` cases in the order of their numbers, three lines for each case."""
    lines = documents.manifest_lines(F.col(KEY), {"record_class": F.col("Segment"), "bf_001": F.col("HORef")}, publisher, prefix)
    # Numbers of one prefix differ in their last digits, so a cut number follows their order.
    batched = ranking.batch(cases, [KEY], f"left({KEY}, 8)", size)
    return documents.manifest_batches(batched.withColumn("_lines", lines), "batch_id", KEY, "_lines")


def retention_metadata(
    cases: DataFrame, people: DataFrame, statuses: DataFrame, pairs: DataFrame, segment: DataFrame,
    as_of: str, publisher: str, region: str, entitlement: str,
) -> DataFrame:
    """The archive record of a case. The event date is the latest decision when its (status, outcome)
    pair is a final one, the one before for an adjournment (4/38, 19/38), else the day of the run."""
    last = ranking.top_n_pivot(
        statuses.select(KEY, "StatusId", "DecisionDate", "CaseStatus", "Outcome"), [KEY], ["StatusId"],
        {"latest": ("DecisionDate", 1), "previous": ("DecisionDate", 2), "CaseStatus": ("CaseStatus", 1), "Outcome": ("Outcome", 1)},
    )
    run = F.lit(as_of).cast("timestamp_ntz")
    wide = joins.assemble(cases, [people, last, segment], KEY)
    marked = joins.in_pairs(wide, ["CaseStatus", "Outcome"], pairs, "final_pair")
    adjourned = (F.col("Outcome") == 38) & F.col("CaseStatus").isin(4, 19)
    event = F.when(F.col("final_pair"), F.coalesce("latest", run)).when(adjourned, F.coalesce("previous", run)).otherwise(run)
    return marked.select(
        F.col(KEY).alias("client_identifier"),
        dates.iso_z(event).alias("event_date"),
        dates.iso_z(run).alias("recordDate"),
        F.lit(region).alias("region"),
        F.lit(publisher).alias("publisher"),
        F.col("Segment").alias("record_class"),
        F.lit(entitlement).alias("entitlement_tag"),
        F.col("HORef").alias("bf_001"),
        F.col("Appellant_Forenames").alias("bf_002"),
        F.col("Appellant_Name").alias("bf_003"),
        dates.iso_z(F.col("BirthDate")).alias("bf_004"),
        F.col("Appellant_Postcode").alias("bf_006"),
    )


def _numbered(column: str, width: int = 1) -> Column:
    return F.floor(F.col(column) / width)


def combined_cases(
    cases: DataFrame, tables: CaseTables, documents_received: DataFrame, links: DataFrame, size: int = aggregates.PART, weighed: DataFrame | None = None
) -> DataFrame:
    """The combined archive record of each case with its eight child families, in parts (``combine``).

    ``cases`` has one row per case with the columns of the record itself; ``links`` the group and place of linked cases, of
    which the other members follow (``linking``); ``weighed`` has those cases or more and is counted for them. Dates order what
    has dates, ids the rest.
    """
    days = F.datediff(F.to_date("DateReceived"), F.lit("1970-01-01"))
    families = [
        combine.Family("statuses", tables.statuses, ["StatusId", "CaseStatus", "Outcome", "DecisionDate", "HearingCentre", "Party"], ["DateReceived", "StatusId"], days),
        combine.Family(
            "hearings", tables.statuses, ["StatusId", "HearingDate", "ListTypeId", "TimeEstimate", "CourtName"], ["StatusId"], _numbered("StatusId", 10_000),
            where=F.col("HearingDate").isNotNull(),
        ),
        combine.Family("transactions", tables.transactions, ["TransactionId", "TransactionTypeId", "Amount", "Status"], ["TransactionId", "TransactionTypeId", "Amount", "Status"], _numbered("TransactionId", 10_000)),
        combine.Family("judges", tables.judges, ["Judge_Surname", "Judge_Forenames", "Judge_Title", "Required"], ["Judge_Surname", "Judge_Forenames", "Judge_Title", "Required"], F.ascii("Judge_Surname")),
        combine.Family("categories", tables.categories.select(KEY, "CategoryId"), ["CategoryId"], ["CategoryId"], F.col("CategoryId"), distinct=True),
        combine.Family("history", tables.history, ["HistoryId", "HistType", "Comment"], ["HistoryId"], _numbered("HistoryId", 10_000)),
        combine.Family("documents", documents_received, ["ReceivedDocumentId", "DateReceived"], ["DateReceived", "ReceivedDocumentId"], days),
        combine.Family("links", links, ["LinkNo", "position", "peers"], ["LinkNo"], F.col("LinkNo"), weighed=weighed),
    ]
    return combine.combine(cases, families, KEY, size)


def combined_officers(officers_: DataFrame, centres: DataFrame, roles: DataFrame, history: DataFrame, key: str = "AdjudicatorId", size: int = aggregates.PART) -> DataFrame:
    """The combined record of each officer: other centres, appointments and history, newest last."""
    families = [
        combine.Family("OtherCentres", centres.distinct(), ["OtherCentre"], ["OtherCentre"], F.ascii("OtherCentre")),
        combine.Family("Roles", roles, ["Role", "DateOfAppointment", "EndDateOfAppointment"], ["DateOfAppointment", "Role", "EndDateOfAppointment"], F.year("DateOfAppointment")),
        combine.Family("History", history, ["HistDate", "HistType", "UserName", "Comment"], ["HistDate", "HistType", "UserName", "Comment"], F.datediff(F.to_date("HistDate"), F.lit("1970-01-01"))),
    ]
    return combine.combine(officers_, families, key, size)


# Seat positions of a sitting, and how a sitting shows them.
SEATS = {"chair": 10, "second": 11, "third": 12, "clerk": 3}


# Cases with at most so many status rows, and so many of them with a bench, are written where one shuffle brings them.
SHORT = 50


def _line() -> Column:
    shown = lambda before, value, after="": F.coalesce(F.concat(F.lit(before), value, F.lit(after)), F.lit(""))
    return F.concat(
        F.coalesce(F.date_format("DateReceived", "yyyy-MM-dd"), F.lit("undated")),
        shown(" at ", F.col("HearingCentre")),
        shown(", ", F.col("CourtName")),
        shown(" before ", F.nullif(F.concat_ws(", ", "chair", "second", "third"), F.lit(""))),
        shown(" (clerk ", F.col("clerk"), ")"),
        F.when(F.col("depth") > 0, F.concat(F.lit(" put off "), F.col("depth").cast("string"), F.lit(" times since "), F.date_format("root_DateReceived", "yyyy-MM-dd"))).otherwise(""),
        F.when(F.col("in_loop"), " put off in a loop").otherwise(""),
    )


def _bench(sittings: DataFrame) -> DataFrame:
    return joins.role_pivot(sittings, [KEY, "StatusId"], "Position", SEATS, "FullName")


def _followed(own_parent: Column, own_date: Column) -> Column:
    """Depth, loop and first date of a chain inside its case: ``_ids``, ``_parents`` and ``_dates`` are those of all rows of the case.

    As many steps as the case has rows lead to the root; a row that still has a parent then is in a loop or ends in one.
    """
    start = F.struct(own_parent.alias("at"), F.lit(0).cast("long").alias("depth"), own_date.alias("since"))

    def up(s: Column, _: Column) -> Column:
        row = F.get("_parents", (F.array_position("_ids", s["at"]) - 1).cast("int"))
        there = F.struct(row["p"].alias("at"), (s["depth"] + 1).alias("depth"), row["d"].alias("since"))
        return F.when(F.array_contains("_ids", s["at"]), there).otherwise(s)

    return F.aggregate("_ids", start, up)


def _short_cases(statuses: DataFrame, sittings: DataFrame, size: int, tasks: int | None) -> DataFrame:
    """The texts of the cases whose chains are followed where their rows meet, and the rows of all others in ``_far``.

    Status rows and sittings are shuffled by case once each. A case is left to the others if it has no number, over ``SHORT`` rows or
    benches, or rows whose status id is missing or repeats.
    """
    order = ["DateReceived", "StatusId"]
    case = Window.partitionBy(KEY)
    along = case.orderBy(*order)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same = statuses.schema["ParentStatusId"].dataType == statuses.schema["StatusId"].dataType
    as_id = (lambda c: F.col(c)) if same else (lambda c: F.col(c).cast("string"))
    placed = statuses.select(
        KEY, *order, "ParentStatusId",
        *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("HearingCentre", "CourtName")],
        F.row_number().over(along).alias("_rn"), F.count(F.lit(1)).over(whole).alias("_n"),
    )
    short = F.col("_n") <= SHORT
    gathered = placed.select(
        "*",
        F.collect_list(F.when(short, as_id("StatusId"))).over(whole).alias("_ids"),
        # The two lists skip other rows; they only count when every row has an id.
        F.collect_list(F.when(short, F.struct(as_id("ParentStatusId").alias("p"), F.col("DateReceived").alias("d")))).over(whole).alias("_parents"),
    )
    far = F.col(KEY).isNull() | (F.size(F.array_distinct("_ids")) < F.col("_n"))
    kept = [KEY, *order, "ParentStatusId", "HearingCentre", "CourtName"]
    chained = gathered.select(*kept, "_rn", far.alias("_apart"), F.when(~far, _followed(as_id("ParentStatusId"), F.col("DateReceived"))).alias("_chain"), F.when(~far, F.col("_ids")).alias("_ids"))
    looped = F.coalesce(F.array_contains("_ids", F.col("_chain.at")), F.lit(False))
    rows = chained.select(
        *kept, "_rn", "_apart", F.when(~looped, F.col("_chain.depth")).alias("depth"), looped.alias("in_loop"), F.col("_chain.since").alias("root_DateReceived")
    )
    # A join by case and status row would shuffle both sides again, so the benches of a case go to its rows as one list.
    seated = sittings.filter(F.col(KEY).isNotNull() & F.col("StatusId").isNotNull() & F.col("Position").isin(*SEATS.values()))
    benches = ranking.top_n(_bench(skew.dealt(seated, [KEY], tasks)), [KEY], [F.col("StatusId")], SHORT + 1)
    listed = benches.groupBy(KEY).agg(F.collect_list(F.struct("StatusId", *SEATS)).alias("_benches"))
    own = F.get("_benches", (F.array_position("_benches.StatusId", F.col("StatusId")) - 1).cast("int"))
    wide = rows.join(listed, KEY, "left").select(
        *rows.columns, (F.col("_apart") | (F.coalesce(F.size("_benches"), F.lit(0)) > SHORT)).alias("_aside"), own.alias("_bench")
    ).select("*", *[F.col(f"_bench.{c}").alias(c) for c in SEATS]).drop("_apart", "_bench")
    lines = wide.select(*kept, F.floor((F.col("_rn") - 1) / size).cast("long").alias("part"), F.col("_aside").alias("_apart"), _line().alias("_text"))
    texts = F.sort_array(F.collect_list(F.when(~F.col("_apart") & F.col("_text").isNotNull(), F.struct(*order, "_text"))))
    return lines.groupBy(KEY, "part").agg(
        F.nullif(F.array_join(F.transform(texts, lambda r: r["_text"]), "\n"), F.lit("")).alias("text"), F.collect_list(F.when(F.col("_apart"), F.struct(*kept))).alias("_far")
    )


def _long_cases(kept: DataFrame, sittings: DataFrame, size: int) -> DataFrame:
    """The texts of cases of any length, with status rows that may repeat; ``kept`` is written, as it is read several times."""
    order = ["DateReceived", "StatusId"]
    name = lambda c: F.concat_ws("|", KEY, F.when(F.col(c).isNotNull(), F.col(c).cast("string")))
    parent = F.when(F.col("ParentStatusId").isNotNull(), name("ParentStatusId"))
    rows = kept.select(KEY, *order, "HearingCentre", "CourtName", name("StatusId").alias("_id"), parent.alias("_parent"))
    put_off = chains.with_root(rows.select("_id", "_parent", "DateReceived"), "_id", "_parent", ["DateReceived"]).select("_id", "depth", "in_loop", "root_DateReceived")
    bench = _bench(sittings.join(kept.select(KEY).distinct(), KEY, "left_semi"))
    wide = rows.join(bench, [KEY, "StatusId"], "left").join(put_off, "_id", "left")
    lines = materialise(wide.select(KEY, *order, _line().alias("_line")), "hearing-lines")
    return aggregates.concat_agg(lines, [KEY], F.col("_line"), "\n", "text", order, F.to_date("DateReceived"), size)


def hearing_texts(
    statuses: DataFrame, sittings: DataFrame, size: int = aggregates.PART, tasks: int | None = None, light: int | None = None, weighed: Sequence[DataFrame] | None = None
) -> DataFrame:
    """The hearings of each case as text, a line for each status row, in parts of ``size`` lines.

    ``statuses`` has DateReceived, HearingCentre, CourtName and ParentStatusId, the status row that it adjourns; ``sittings``
    the FullName of an officer per status row and Position. A line names the place, which holds until another one is given, the
    bench by seats, and for an adjournment how often the hearing was put off and since when.

    Cases of some ``SHORT`` rows are written where one shuffle of status rows and one of sittings bring them; ``tasks`` is the
    number of tasks that the status rows were dealt to, if they were. For all others, and those of keys that may be hot, the place is carried along without a case in one task, and
    adjournments of adjournments are followed to the first one in rounds. ``weighed`` has the same cases as the two, for rows
    that are cheaper to count.
    """
    order = ["DateReceived", "StatusId"]
    full = skew.full_cells([df.select(KEY) for df in weighed or (statuses, sittings)], [KEY], light)
    near, near_sittings = (skew.in_cells(df, [KEY], full, False) for df in (statuses, sittings))
    written = materialise(_short_cases(near, near_sittings, size, tasks), "hearings")
    found = written.filter(F.size("_far") == 0).select(KEY, "part", "text")
    rest = written.filter(F.size("_far") > 0).select(F.inline("_far"))
    if full is not None:
        hot = skew.in_cells(statuses, [KEY], full, True)
        carried = skew.carry_forward(hot, [KEY], order, F.to_date("DateReceived"), ["HearingCentre", "CourtName"])
        rest = materialise(rest.unionByName(carried.select(*rest.columns)), "hearings")
    return found if rest.isEmpty() else found.unionByName(_long_cases(rest, sittings, size))
