"""Command line: python -m lodestone scan|validate|measure|extract|finalize|publish|summary|repair|footer|card ..."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .operators import finalize, profile, reports
from .operators.resolve import labelled
from .sources import card, corpus, gzip_repair, publish
from .sources.shared import stored
from .streaming.incremental import extract_new, extracted


def _files(spark: SparkSession, a: argparse.Namespace, profile_name: str, kept: Callable[[DataFrame], DataFrame] = lambda repos: repos) -> DataFrame:
    """Files of the corpus, or of evenly spaced shards of it, in those repositories that are kept."""
    if not a.shards:
        return corpus.flatten(kept(corpus.read_corpus(spark, a.source, profile_name)))
    numbers = [r.shard for r in corpus.sample_indices(spark, a.shards, a.total_shards).collect()]
    return corpus.flatten(kept(corpus.read_corpus(spark, [corpus.shard_path(a.source, n, a.revision) for n in numbers], profile_name)))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="lodestone")
    p.add_argument("command", choices=["scan", "validate", "measure", "extract", "finalize", "publish", "summary", "repair", "footer", "card"])
    p.add_argument("source")
    p.add_argument("--out", default="out")
    p.add_argument("--shards", type=int, default=0)
    p.add_argument("--total-shards", type=int, default=corpus.TOTAL_SHARDS)
    p.add_argument("--revision", default="")
    p.add_argument("--run-tag", default="run")
    p.add_argument("--checkpoint", default="")
    p.add_argument("--surviving", default="", help="a revision to keep repositories of")
    p.add_argument("--config", choices=list(publish.QUALITY), default="helm_chart")
    p.add_argument("--codec", choices=publish.CODECS, default="zstd")
    p.add_argument("--sample", type=int, default=20)
    p.add_argument("--samples", default="", help="a folder for the sampled units' files")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"lodestone {a.command}").getOrCreate()
    save = lambda df, name: df.write.mode("overwrite").json(f"{a.out}/{name}")
    if a.command == "scan":
        files = _files(spark, a, "metadata")
        save(reports.tool_volume(files, core_only=False), "tools")
        save(reports.extrapolated(reports.scalars(files), a.total_shards), "scalars")
        save(reports.top(reports.languages(files), reports.MOST_LANGUAGES, "files", "language"), "languages")
        save(reports.licences_of_matched(files), "licenses")
        save(reports.core_star_buckets(files), "stars")
    elif a.command == "validate":
        files = _files(spark, a, "content")
        save(reports.validation_recall(files), "recall")
        save(reports.validation_precision(files), "precision")
        save(reports.confirmations(files), "confirmations")
    elif a.command == "measure":
        files = _files(spark, a, "content")
        rows = reports.measured(files, labelled(files))
        save(reports.measure_precision(rows), "precision")
        save(reports.measure_recall(rows), "recall")
        save(reports.unlabelled_top(reports.unlabelled_profile(rows)), "unlabelled")
    elif a.command == "extract" and a.checkpoint:
        extract_new(spark, a.source, a.out, a.checkpoint)
    elif a.command == "extract":
        for unit_type, records in extracted(stored(_files(spark, a, "content", corpus.unforked), "files")).items():
            records.write.mode("errorifexists").option("compression", "gzip").json(f"{a.out}/run={a.run_tag}/unit_type={unit_type}")
    elif a.command in ("finalize", "publish", "summary"):
        units = corpus.read_units(spark, a.source, publish.schema_ddl(a.config))
        if a.command == "finalize":
            surviving = corpus.surviving_repos(corpus.read_corpus(spark, a.surviving, "repo_only"), corpus.cited_repos(units)) if a.surviving else None
            finalize.finalized(units, a.config, surviving).where("reason = ''").drop("reason", "removed").write.mode("errorifexists").option("compression", "gzip").json(f"{a.out}/{a.config}")
            save(finalize.finalize_stats(units, a.config, surviving), f"stats_{a.config}")
        elif a.command == "publish":
            publish.write_config(units.where("_corrupt is null"), a.config, a.out, a.codec)
        else:
            save(profile.class_profile(units), "profile")
            sample = profile.stable_sample(units, a.sample)
            save(sample, "sample")
            if a.samples:
                profile.write_folders(sample, a.samples)
    elif a.command == "repair":
        gzip_repair.repaired(gzip_repair.read_damaged(spark, a.source)).select("line").write.mode("errorifexists").option("compression", "gzip").text(a.out)
    elif a.command == "card":
        configs = [c for c in card.ORDER if Path(a.out, "data", c).is_dir()]
        stats = publish.published_stats(a.out, spark, configs)
        values = {"CONFIGS_TABLE": card.table(stats), "TOTAL_UNITS": f"{sum(s['rows'] for s in stats):,}"}
        Path(a.out, "README.md").write_text(card.render(Path(a.source).read_text(encoding="utf-8"), values), encoding="utf-8")
    else:
        corpus.leaf_shares(corpus.footer(spark, a.source)).show(100, truncate=False)


if __name__ == "__main__":
    main()
