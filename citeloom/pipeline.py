"""The phases of a run over a folder of tables, and the command line.

``python -m citeloom.pipeline etl --data DIR --out DIR`` runs extraction, transformation and load (or those named) and
ends with 0, or with 3 if a phase has an error. ``python -m citeloom.pipeline score --data DIR --golden DIR`` scores
records against a golden set and ends with 0, or with 1 if an evaluator fails.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators import checks as K
from citeloom.operators import evaluate as E
from citeloom.operators import grounding as G
from citeloom.operators import parsers as P
from citeloom.operators import runlog, serve
from citeloom.operators import warehouse as W
from citeloom.plans.staging import staged
from citeloom.sources import read_table
from citeloom.sources.documents import write_report

PHASES = ("extract", "transform", "load")
REPLY = "struct<title:string,description:string,mitigation:string>"


def recorded_repairs(calls: DataFrame) -> DataFrame:
    """``id, title, description, mitigation`` of the recorded repair of each record, the last one of its first call."""
    kind, reply = F.split_part("call_id", F.lit("-"), F.lit(1)), F.col("response_content")
    rows = calls.where((kind == "repair") & F.json_object_keys(reply).isNotNull() & F.expr("try_parse_json(response_content)").isNotNull())
    last = rows.groupBy("call_id").agg(F.max_by(reply, F.struct("created_at", reply)).alias("r"))
    named = last.select(F.regexp_extract("call_id", "^[a-z]+-(.*)-[^-]+$", 1).alias("id"), "call_id", F.from_json("r", REPLY).alias("r"))
    return named.groupBy("id").agg(F.min_by("r", "call_id").alias("r")).select("id", "r.*")


@dataclass
class Run:
    """One run: tables are read from ``data`` and written under ``out``."""

    spark: SparkSession
    data: str
    out: str
    run_id: str
    grounding: str = "plain"
    replay: bool = True
    break_parser: bool = False
    logs: list[DataFrame] = field(default_factory=list)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.data, name)

    def log(self, checks: DataFrame) -> DataFrame:
        rows = staged(K.stamped(checks, self.run_id), "checks")
        self.logs.append(rows)
        rows.write.mode("append").parquet(f"{self.out}/run_checks")
        return rows

    def extract(self) -> DataFrame:
        """Pages to blocks. Without a table of positioned words every page is a plain block."""
        pages = G.page_texts(self.table("page_text")).select(F.col("report_id").alias("doc_id"), (F.col("page") - 1).alias("pdf_index"), "page", F.lit("pages").alias("section"), F.lit(None).cast("string").alias("layout"), F.col("page_text").alias("text"))
        checks = []
        if self.break_parser:
            blocks = P.equal_chunks(pages)
            checks.append(K.parser_override(pages.select(F.col("doc_id").alias("report_id")), "equal_chunks"))
        else:
            blocks = P.plain_blocks(pages)
        blocks.write.mode("overwrite").parquet(f"{self.out}/blocks")
        own = self.spark.read.parquet(f"{self.out}/blocks").withColumnRenamed("doc_id", "report_id")
        ranges = own.groupBy("report_id", "section").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
        words = pages.select(F.col("doc_id").alias("report_id"), "page", F.col("text").alias("word"), F.lit(K.HEADER_BAND + 1).alias("top"))
        checks += [K.marker_checks(own), K.range_check(own, ranges), K.drift_check(K.marker_counts(own), None), K.text_checks(own, pages.select(F.col("doc_id").alias("report_id"), "page", "text"), words)]
        return self.log(K.union(checks))

    def transform(self) -> DataFrame:
        """Records checked against their text and mended from recorded repairs."""
        records, pages, cites = self.table("risk_instance"), self.table("page_text"), self.table("risk_citation")
        repairs = recorded_repairs(self.table("calls")) if self.replay else self.spark.createDataFrame([], "id string, title string, description string, mitigation string")
        done = staged(G.repaired(records, pages, cites, repairs, self.grounding), "records")
        done.drop("problems", "repaired").write.mode("overwrite").parquet(f"{self.out}/records")
        whole = records.groupBy("report_id").agg(F.count("*").alias("candidates")).withColumn("merges", F.lit(0))
        again = G.repaired(records, pages, cites, repairs, self.grounding)
        return self.log(K.union([
            K.identify_checks(records.groupBy("report_id", "source_register").agg(F.count("*").alias("n"))), K.counted(done, "category_poor_fit", F.coalesce("poor_fit", F.lit(False)), F.col("id")),
            K.grounding_check(done), K.set_checks(done, whole), K.reproducibility(done, again, ["id", "title", "description", "mitigation", "review_state"]),
        ]))

    def load(self) -> DataFrame:
        """The tables of all reports as one unit, and what was written against what was to be."""
        records = self.spark.read.parquet(f"{self.out}/records")
        placed = self.table("risk_citation").join(records.select(F.col("id").alias("risk_instance_id"), "report_id"), "risk_instance_id")
        tables = {
            "company": self.table("company"), "report": self.table("report"), "canonical_risk": self.table("canonical_risk"), "risk_instance": records, "risk_citation": placed,
            "risk_category": W.categories(records).join(records.select(F.col("id").alias("risk_instance_id"), "report_id"), "risk_instance_id"),
        }
        store = f"{self.out}/store"
        W.load_reports(tables, store, self.run_id)
        stored = W.stored(self.spark, store, "risk_instance")
        t = serve.Tables(*(W.stored(self.spark, store, n) for n in ("company", "report", "canonical_risk", "risk_instance", "risk_citation")))
        top = serve.records(t, serve.Intent(source_register="erm_main_risk"), None).select("report_id")
        cyber = serve.records(t, serve.Intent(categories=["cyber"]), None).select("report_id")
        return self.log(K.union([K.rows_check(stored, records), K.questions_check({"top_enterprise_risks": top, "companies_with_category": cyber})]))


def run_phases(run: Run, phases: list[str], keep_going: bool = False) -> str:
    """Run the phases in their order; one that ends with an error stops the others unless ``keep_going``. Gives the worst
    status."""
    worst = "ok"
    for phase in (p for p in PHASES if p in phases):
        status = runlog.status(getattr(run, phase)().withColumn("all", F.lit(1)), ["all"]).first()["status"]
        worst = max(worst, status, key=("ok", "warnings", "error").index)
        if status == "error" and not keep_going:
            break
    return worst


def score_run(spark: SparkSession, data: str, golden: str, out: str | None = None) -> bool:
    """Score the records of ``data`` against ``golden``, a table with ``report_id, golden_id`` and the struct ``golden`` (page,
    section, key phrases, categories, stated mitigation), matched by canonical id. Writes a report and tells whether every
    evaluator passes in every report."""
    records = read_table(spark, data, "risk_instance")
    sources = G._with_sources(records, read_table(spark, data, "page_text"), read_table(spark, data, "risk_citation"))
    cited = read_table(spark, data, "risk_citation").groupBy(F.col("risk_instance_id").alias("id")).agg(F.collect_set("page").alias("pages"), F.collect_set("section").alias("sections"))
    own = sources.join(cited, "id", "left").withColumn("page_text", F.concat_ws(" ", "page_text", "cited_pages"))
    record = F.struct("page", "section", "pages", "sections", "description", "mitigation", "category", "page_text")
    matched = own.select("report_id", F.col("canonical_risk_id").alias("golden_id"), record.alias("record")).join(spark.read.parquet(golden), ["report_id", "golden_id"])
    scores = staged(E.evaluated(E.match_problems(matched, "report_id"), "report_id"), "scores")
    wanted, found = spark.read.parquet(golden).select("report_id", "golden_id"), own.select("report_id", F.col("canonical_risk_id").alias("golden_id"))
    ident = E.identification_passes(E.identification(wanted, found, ["golden_id"], ["report_id"]), wanted, found, ["golden_id"], "report_id")
    if out:
        write_report(scores, f"{out}/evaluators")
        write_report(ident, f"{out}/identification")
    return not scores.where("NOT passed").take(1) and not ident.where("NOT passed").take(1)


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="citeloom")
    commands = top.add_subparsers(dest="command", required=True)
    etl = commands.add_parser("etl")
    for phase in PHASES:
        etl.add_argument(f"--{phase}", action="store_true")
    etl.add_argument("--data"), etl.add_argument("--out"), etl.add_argument("--run-id")
    etl.add_argument("--no-replay", action="store_true"), etl.add_argument("--break-parser", action="store_true"), etl.add_argument("--list", action="store_true")
    etl.add_argument("--grounding", choices=sorted(G.BACKENDS), default="plain")
    score = commands.add_parser("score")
    score.add_argument("--data", required=True), score.add_argument("--golden", required=True), score.add_argument("--out")
    args = top.parse_args(argv)
    if args.command == "etl" and args.list:
        print("\n".join(PHASES))
        return 0
    spark = SparkSession.builder.appName("citeloom").getOrCreate()
    if args.command == "score":
        return 0 if score_run(spark, args.data, args.golden, args.out) else 1
    name = args.run_id or spark.range(1).select(K.run_id()).first()[0]
    run = Run(spark, args.data, args.out, name, args.grounding, not args.no_replay, args.break_parser)
    status = run_phases(run, [p for p in PHASES if getattr(args, p)] or list(PHASES))
    for rows in run.logs:
        for line in runlog.rendered(rows.where("outcome <> 'ok'")).limit(20).collect():  # a glance; the whole log is written
            print(line["line"][:200])
    print(f"{name} {status}")
    return 3 if status == "error" else 0


if __name__ == "__main__":
    sys.exit(main())
