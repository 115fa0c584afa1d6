"""Nested match documents: read, quarantine, flatten.

A document is one JSON object ``{info: {dates, venue, teams}, innings: [{team,
overs: [{over, deliveries: [{batter, bowler, runs: {batter, extras, total},
wickets: [{kind}]}]}]}]}``.  Production input is one pretty-printed document
per file (``multi_line=True``: a file is one record, files are packed into
tasks); JSON Lines (one document per line), in compressed files of bounded size, is
what :func:`write_match_documents` produces.

Flattening is three generators in one narrow stage -- no shuffle, no Python.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease import schema as S
from crease.session import scratch_path
from crease.sources.storage import delete

DOCUMENTS_A_FILE = 200_000   # of the writer: about 60 MB of text, read by one task


def read_match_documents(spark: SparkSession, path: str, multi_line: bool = True,
                         glob: str | None = "*.json") -> DataFrame:
    """Documents with ``file_path`` and ``_corrupt_record`` (PERMISSIVE mode).

    An unparseable file, or a document with a wrong-typed field, gets a
    non-null ``_corrupt_record``; it is quarantined whole, never half-read.
    """
    r = (spark.read.schema(S.MATCH_WITH_CORRUPT)
         .option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record")
         .option("multiLine", multi_line))
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.json(path)
    # The reader converts only the columns a query needs and flags a wrong-
    # typed field only when it converts it.  ``_bad`` references both whole
    # structs, so any query filtering on it parses full documents and the
    # verdict cannot depend on the final projection.  The second operand runs
    # only for already-flagged documents (short-circuit) and is always true.
    bad = F.col("_corrupt_record").isNotNull() & (
        F.length(F.to_json(F.struct(F.col("info"), F.col("innings")))) >= 0)
    return df.select("*", F.col("_metadata.file_path").alias("file_path"), bad.alias("_bad"))


def match_key() -> Column:
    """Match id = first date, ``'unknown'`` when the list is missing or empty."""
    return F.coalesce(F.get(F.col("info.dates"), 0), F.lit(S.UNKNOWN))


def quarantine(docs: DataFrame) -> DataFrame:
    """Documents that failed to parse (whole file / whole document).

    ``match_id`` is whatever could still be read (siblings of a bad field
    still parse).
    """
    return (docs.filter(F.col("_bad"))
            .select("file_path", F.get(F.col("info.dates"), 0).alias("match_id"),
                    "_corrupt_record"))


def valid_documents(docs: DataFrame) -> DataFrame:
    return docs.filter(~F.col("_bad"))


def quarantine_report(docs: DataFrame) -> DataFrame:
    """Documents read / valid / quarantined and deliveries in valid documents."""
    n_deliveries = F.aggregate(
        F.coalesce(F.col("innings"), F.array()), F.lit(0).cast("long"),
        lambda acc, inn: acc + F.aggregate(
            F.coalesce(inn["overs"], F.array()), F.lit(0).cast("long"),
            lambda a2, ov: a2 + F.coalesce(F.size(ov["deliveries"]), F.lit(0)).cast("long")))
    bad = F.col("_bad")
    return docs.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count(F.when(~bad, F.lit(1))).alias("valid_documents"),
        F.count(F.when(bad, F.lit(1))).alias("quarantined_documents"),
        F.coalesce(F.sum(F.when(~bad, F.greatest(n_deliveries, F.lit(0)))), F.lit(0))
        .cast("long").alias("deliveries"))


def flatten(docs: DataFrame, keep_teams: bool = False) -> DataFrame:
    """One row per delivery from valid documents.

    Missing (or null) names default to ``''``, runs and over to 0, venue to
    ``'unknown'``; ball = 1-based position in the over's delivery list; the
    wicket is the first wicket's kind ('' -> null); later wickets are dropped.
    """
    # The small ``info`` struct rides through the generators and is unpacked
    # after them: extracting its fields next to a generator trips Spark 4.1's
    # nested-column aliasing when the plan is also capped and cached.
    m = valid_documents(docs).select("info", "file_path", F.explode(F.col("innings")).alias("inn"))
    o = m.select("info", "file_path",
                 F.coalesce(F.col("inn.team"), F.lit("")).alias("batting_team"),
                 F.explode(F.col("inn.overs")).alias("ov"))
    d = o.select("info", "file_path", "batting_team",
                 F.coalesce(F.col("ov.over"), F.lit(0)).alias("over_num"),
                 F.posexplode(F.col("ov.deliveries")).alias("pos", "d"))
    out = d.select(
        match_key().alias("match_id"),
        F.expr("try_to_date(coalesce(get(info.dates, 0), 'unknown'), 'yyyy-MM-dd')")
        .alias("match_date"),
        F.coalesce(F.col("info.venue"), F.lit(S.UNKNOWN)).alias("venue"),
        "batting_team",
        F.coalesce(F.col("d.batter"), F.lit("")).alias("batter"),
        F.coalesce(F.col("d.bowler"), F.lit("")).alias("bowler"),
        "over_num",
        (F.col("pos") + 1).alias("ball_num"),
        F.coalesce(F.col("d.runs.batter"), F.lit(0)).alias("runs_off_bat"),
        F.coalesce(F.col("d.runs.extras"), F.lit(0)).alias("extras"),
        F.coalesce(F.col("d.runs.total"), F.lit(0)).alias("total_runs"),
        F.nullif(F.get(F.col("d.wickets"), 0)["kind"], F.lit("")).alias("wicket"),
        "file_path",
        F.coalesce(F.col("info.teams"), F.array().cast("array<string>")).alias("teams"))
    return out if keep_teams else out.drop("teams")


def match_titles(docs: DataFrame) -> DataFrame:
    """``first team vs second team`` per match id; null with fewer than two teams."""
    t = valid_documents(docs).select(match_key().alias("match_id"),
                                     F.col("info.teams").alias("teams"))
    return (t.select("match_id",
                     F.when(F.size("teams") >= 2,
                            F.concat_ws(" vs ", F.get("teams", 0), F.get("teams", 1)))
                     .alias("title"))
            .distinct())


def validate_inputs(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Input presence check: file count and bytes (file listing only, contents unread).

    Raises when nothing matches -- a scheduled run must not publish empty results.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .load(path).select("path", "length"))
    n, size = files.agg(F.count(F.lit(1)), F.sum("length")).first()
    if n == 0:
        raise ValueError(f"no input files matching {glob} under {path}")
    return spark.sql(f"SELECT CAST({n} AS BIGINT) AS files, CAST({size} AS BIGINT) AS bytes")


def write_match_documents(deliveries: DataFrame, path: str, broken: Column | None = None) -> None:
    """Nest flat deliveries back into match documents, one JSON line each.

    One document per (match, venue, innings team, over) and, if the rows have one,
    ``doc_no``: with it a document holds the few deliveries of one source order, so
    no list -- and no line -- grows with the data.  ``info.teams`` is the sorted
    set of batting teams of the match (one small aggregate per match, written first: its
    size is known when it is joined, so that the documents, many times wider, are
    shuffled for it only if it is too large to be sent to every task).  Files are
    compressed, as documents repeat their field names, teams and players.
    Deliveries inside an over are ordered by (ball_num, batter, bowler,
    runs, extras, total, wicket), which defines the ball positions.

    Documents for which ``broken`` (over those keys) holds are cut off in the
    middle, as an interrupted upload leaves them.
    """
    spark = deliveries.sparkSession
    listed = scratch_path(spark, "match-teams")
    teams = (deliveries.groupBy("match_id")
             .agg(F.sort_array(F.collect_set("batting_team")).alias("teams")))
    teams.write.parquet(listed)
    teams = spark.read.schema(teams.schema).parquet(listed)
    item = F.struct(
        F.col("ball_num").alias("k0"),
        F.coalesce(F.col("batter"), F.lit("")).alias("k1"),
        F.coalesce(F.col("bowler"), F.lit("")).alias("k2"),
        F.col("runs_off_bat").alias("k3"), F.col("extras").alias("k4"),
        F.col("total_runs").alias("k5"),
        F.coalesce(F.col("wicket"), F.lit("")).alias("k6"),
        F.struct(
            F.col("batter").alias("batter"), F.col("bowler").alias("bowler"),
            F.struct(F.col("runs_off_bat").alias("batter"), F.col("extras").alias("extras"),
                     F.col("total_runs").alias("total")).alias("runs"),
            F.when(F.col("wicket").isNotNull(),
                   F.array(F.struct(F.col("wicket").alias("kind")))).alias("wickets"),
        ).alias("d"))
    # collect_list keeps every value, so a map-side partial aggregate saves
    # nothing: shuffle by the document key first and build lists in parallel
    keys = ["match_id", "venue", "batting_team", "over_num"]
    keys += [c for c in ("doc_no",) if c in deliveries.columns]
    overs = (deliveries.repartition(*keys).groupBy(*keys)
             .agg(F.sort_array(F.collect_list(item)).alias("items")))
    doc = F.to_json(F.struct(
        F.struct(F.array(F.col("match_id")).alias("dates"), F.col("venue").alias("venue"),
                 F.col("teams").alias("teams")).alias("info"),
        F.array(F.struct(
            F.col("batting_team").alias("team"),
            F.array(F.struct(
                F.col("over_num").alias("over"),
                F.transform("items", lambda x: x["d"]).alias("deliveries")))
            .alias("overs"))).alias("innings")))
    if broken is not None:
        doc = F.when(broken, F.left(doc, F.length(doc) - 3)).otherwise(doc)
    (overs.join(teams, "match_id").select(doc.alias("value")).write.mode("overwrite")
     .option("maxRecordsPerFile", DOCUMENTS_A_FILE).option("compression", "gzip").text(path))
    delete(spark, listed)
