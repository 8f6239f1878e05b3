"""Commands over Parquet tables and folders: python -m lexforge.cli COMMAND ..."""

import argparse
import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.operators import names, summaries, validation, work
from lexforge.plans import pipeline
from lexforge.sources import files


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexforge", description=__doc__)
    of = top.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *arguments: str, **flags) -> None:
        p = of.add_parser(name, help=about)
        for a in arguments:
            p.add_argument(a)
        for flag, options in flags.items():
            p.add_argument(f"--{flag.replace('_', '-')}", **options)

    command("discover", "supported files below a folder", "folder", out={})
    command("extract-text", "texts of the supported files below a folder", "folder", "out", json={"action": "store_true"})
    command("ner", "tier one: spans and a manifest", "documents", "out", least_confidence={"type": float, "default": 0.3})
    command("names", "tier two: names of documents, from tier one's spans where given", "documents", "out", spans={}, no_recovery={"action": "store_true"})
    command("clean-names", "clean names; without --apply only statistics", "names", out={}, apply={"action": "store_true"})
    command("pending", "stems without an output, and a worker's share", "inputs", "outputs", workers={"type": int, "default": 1}, worker={"type": int, "default": 0})
    command("manifest-query", "files by spans", "manifest", min={"type": int, "default": 0}, max={"type": int}, limit={"type": int}, sort={"choices": ["person_spans", "clean_text_length"], "default": "person_spans"})
    command("validate", "stored names against their sources; status 1 where some don't hold", "names", "documents", fix={}, verbose={"action": "store_true"})
    command("validate-summaries", "empty and corrupted summary files", "folder", delete={"action": "store_true"})
    command("summarise", "map and reduce of documents (file_id, page_number, text) by a backend", "pages", "out", backend={"default": "mock"}, model={"default": "mock"}, prompts={"default": "1"})
    command("to-summarise", "documents without a valid summary", "documents", "cache", model={"required": True}, prompts={"required": True}, resume_from={}, limit={"type": int})
    return top


def show(df: DataFrame) -> None:
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(recursive=True), default=str, ensure_ascii=False))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    read = spark.read.parquet
    if a.command == "discover":
        found = files.discovered(spark, a.folder)
        files.write(found, a.out) if a.out else show(found)
    elif a.command == "ner":
        docs = read(a.documents)
        found = pipeline.tier_one(docs, options=pipeline.Options(least_confidence=a.least_confidence))
        files.write(found, f"{a.out}/spans")
        files.append_manifest(pipeline.manifest(docs, read(f"{a.out}/spans"), time.time_ns()), f"{a.out}/manifest")
    elif a.command == "names":
        docs, options = read(a.documents), pipeline.Options(recovery=not a.no_recovery)
        found = read(a.spans) if a.spans else pipeline.tier_one(docs, options=options)
        files.write(pipeline.tier_two(docs, found, options=options), a.out)
    elif a.command == "clean-names":
        rows = read(a.names)
        if a.apply:
            files.write(names.clean_files(rows), a.out)
        show(names.statistics(rows))
    elif a.command == "pending":
        if not 0 <= a.worker < a.workers:
            raise SystemExit("--worker must be below --workers")
        show(work.assigned(work.pending(read(a.inputs), read(a.outputs)), a.workers).filter(F.col("worker") == a.worker).select("stem"))
    elif a.command == "manifest-query":
        show(work.top(work.latest(read(a.manifest)) if "seq" in read(a.manifest).columns else read(a.manifest), a.min, a.max, a.sort, a.limit))
    elif a.command == "validate":
        checked = validation.issues(read(a.names), read(a.documents))
        report = validation.report(checked).first()
        print(json.dumps(report.asDict()))
        if a.verbose:
            show(checked.filter("issue_type IS NOT NULL"))
        if a.fix:
            files.write(validation.fixed(checked), a.fix)
        return int(report.invalid_names > 0)
    elif a.command == "validate-summaries":
        broken = files.broken_summaries(spark, a.folder)
        if a.delete:
            print(json.dumps({"deleted": files.delete(spark, [r.path for r in broken.select("path").toLocalIterator()])}))
        else:
            show(broken)
    elif a.command == "extract-text":
        (files.write_json if a.json else files.write)(files.extracted(spark, a.folder), a.out)
    elif a.command == "summarise":
        files.write(summaries.documents_summarised(read(a.pages), a.backend, a.model, a.prompts), a.out)
    elif a.command == "to-summarise":
        show(summaries.selected(read(a.documents), read(a.cache), a.model, a.prompts, resume_from=a.resume_from, limit=a.limit).select("file_id", "text_hash"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
