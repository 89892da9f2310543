"""Readers, damaged files, publishing, profiles, the card, streaming and plans."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import profile, reports
from lodestone.sources import card, corpus, gzip_repair, publish
from lodestone.streaming.incremental import extract_new


def record(i, shard=0):
    return json.dumps({"repo_path": f"r{i}", "unit_prefix": "", "unit_type": "t", "commit_id": "c", "shard": shard}).encode() + b"\n"


def counts(spark, data):
    rows = gzip_repair.counters(gzip_repair.salvaged(spark.createDataFrame([("f", data)], "name string, bytes binary"))).collect()
    return (rows[0].lines_recovered, rows[0].lines_duplicate, rows[0].lines_unparseable, rows[0].shards_seen) if rows else None


def test_repair(spark):
    body = b"".join(record(i, i % 2) for i in range(2000))
    whole = gzip.compress(body)
    assert counts(spark, whole) == (2000, 0, 0, 2)
    assert counts(spark, whole + whole) == (2000, 2000, 0, 2)
    assert counts(spark, b"") is None
    assert counts(spark, gzip.compress(body[:333]) + gzip.compress(body[333:])) == (2000, 0, 0, 2)
    cut = counts(spark, whole[: len(whole) // 2])
    assert 500 < cut[0] < 2000 and cut[2] <= 1
    both = counts(spark, whole[: len(whole) // 2] + gzip.compress(record("x") + b"not json\n\n"))
    assert both[0] > cut[0] and both[2] > cut[2]  # the cut stream may run on into the next header
    assert counts(spark, b"junk" + whole)[0] == 2000
    damaged = bytearray(whole)
    damaged[len(whole) // 2] ^= 255
    assert counts(spark, bytes(damaged) + whole)[0] == 2000


def test_members_do_not_depend_on_chunks():
    data = gzip.compress(b"a" * 500) + gzip.compress(b"b" * 500) + gzip.compress(b"c" * 500)
    assert [list(gzip_repair.members(data, n)) for n in (1, 7, 64)] == [list(gzip_repair.members(data))] * 3


def test_sample_indices(spark):
    for n in (0, 1, 24, 100, 198, 200):
        assert sorted(r.shard for r in corpus.sample_indices(spark, n).collect()) == sorted({int(i * (corpus.TOTAL_SHARDS / n)) for i in range(n)})
    assert corpus.sample_indices(spark, 9000).count() == corpus.TOTAL_SHARDS
    assert corpus.shard_path("r", 7, "v1") == "r/v1/shard-00007.parquet" and corpus.shard_path("r/", 7) == "r/shard-00007.parquet"


def make_corpus(spark, path, n=3):
    rows = [
        (f"org/r{i}", "c", (i, i == 2), [("Dockerfile", "Dockerfile", 20, "permissive", False, ["MIT"], "FROM a:latest\nRUN b\n"), ("a.tf", None, 5, None, False, [], "x"), (".github/workflows/a.yml", "YAML", 9, "", False, None, "on: push\njobs:\n  a:\n    steps: []\n")])
        for i in range(n)
    ] + [("org/empty", "c", (1, False), []), ("org/null", "c", None, None)]
    spark.createDataFrame(rows, corpus.PROFILES["content"]).coalesce(1).write.mode("append").parquet(path)


def test_metadata_scan_reads_no_content(spark, tmp_path):
    make_corpus(spark, f"{tmp_path}/c")
    files = corpus.flatten(corpus.read_corpus(spark, f"{tmp_path}/c"))
    assert "content" not in files.columns
    plan = reports.tool_volume(files)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "content" not in plan
    assert files.count() == 9 and corpus.without_forks(files).count() == 6 and corpus.with_min_stars(files, 1).count() == 6
    assert {(r.language, r.files) for r in reports.languages(files).collect()} == {("Dockerfile", 3), ("unknown", 3), ("YAML", 3)}
    repos = corpus.read_corpus(spark, f"{tmp_path}/c", "repo_only")
    assert corpus.surviving_repos(repos, spark.createDataFrame([("org/r1",), ("org/zz",)], "repo_path string")).count() == 1


def test_fork_filter_is_pushed_down(spark, tmp_path):
    make_corpus(spark, f"{tmp_path}/c")
    files = corpus.flatten(corpus.unforked(corpus.read_corpus(spark, f"{tmp_path}/c")))
    assert files.count() == 6
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "is_fork" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_a_damaged_member_yields_whole_records_only(spark):
    lines = [("f", 0, 0, True, record(1).decode()), ("f", 0, 1, True, '{"repo_path": "r9c", "shard": 0}'), ("f", 1, 2, False, '{"repo_path": "r2"}')]
    rows = gzip_repair.records(spark.createDataFrame(lines, "name string, member int, seq bigint, truncated boolean, line string")).orderBy("seq").collect()
    assert [r.parsed for r in rows] == [True, False, True]


def test_footer(spark, tmp_path):
    make_corpus(spark, f"{tmp_path}/c")
    shares = {r.leaf: r.share_pct for r in corpus.leaf_shares(corpus.footer(spark, f"{tmp_path}/c")).collect()}
    assert abs(sum(shares.values()) - 100) < 0.5 and "repo_path" in shares
    r = corpus.row_group_sample(spark, f"{tmp_path}/c", 1).first()
    assert (r.rows, r.read, r.total) == (5, 1, 1)


def test_incremental_runs_take_each_file_once(spark, tmp_path):
    source, sink, state = (f"{tmp_path}/{x}" for x in ("c", "out", "state"))
    make_corpus(spark, source)
    run = lambda: extract_new(spark, source, sink, state, unit_types=["dockerfile", "workflow"])
    run()
    read = lambda t: spark.read.schema(publish.schema_ddl(t)).json(f"{sink}/unit_type={t}/*")
    assert read("dockerfile").count() == 2 and read("workflow").count() == 2  # the fork is left out
    run()
    assert read("dockerfile").count() == 2
    make_corpus(spark, source, 1)
    run()
    assert read("dockerfile").count() == 3


def test_publish(spark, tmp_path):
    lines = [
        {"unit_type": "dockerfile", "repo_path": "r", "files": [{"path": "Dockerfile", "content": None}], "quality": {"stages": 1, "files": 1}, "flags": {"file_count": 1, "total_bytes": 10}, "extra": 1},
        {"unit_type": "dockerfile", "repo_path": None, "files": []},
    ]
    (tmp_path / "u.json").write_text("\n".join(map(json.dumps, lines)) + "\n\nbad line\n")
    units = corpus.read_units(spark, f"{tmp_path}/u.json", publish.schema_ddl("dockerfile")).cache()
    assert units.where("_corrupt is not null").count() == 1
    publish.write_config(units.where("_corrupt is null"), "dockerfile", str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/data/dockerfile")
    row = back.where("repo_path = 'r'").first()
    assert (row.stars, row.unit_prefix, row.license_types, row.files[0].content, row.files[0].size_bytes, row.files[0].license_type) == (0, "", [], "", 0, None)
    assert "files" not in row.quality.asDict() and row.quality.stages == 1 and row.quality.has_user is None
    assert back.count() == 2 and publish.published_stats(str(tmp_path), spark, ["dockerfile"])[0]["rows"] == 2
    for bad in (lambda: publish.schema_ddl("nope"), lambda: publish.write_config(units, "dockerfile", str(tmp_path), "lzma")):
        with pytest.raises(ValueError):
            bad()


def test_write_units_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "unit_type string, x int")
    corpus.write_units(rows, str(tmp_path), "one")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        corpus.write_units(rows, str(tmp_path), "one")


def test_numeric_profile(spark):
    df = spark.createDataFrame([("a", v) for v in (2, 3, 4, 10, 40)] + [("b", 10 * i) for i in range(1, 11)], "g string, v bigint")
    got = {r.g: tuple(r)[1:] for r in profile.numeric_profile(df, "g", "v").collect()}
    assert got == {"a": (2, 4, 40, 40, 11.8), "b": (10, 60, 100, 100, 55.0)}


def test_stable_sample(spark):
    df = spark.range(500).select(F.lit("a").alias("unit_type"), F.concat(F.lit("r"), "id").alias("repo_path"), F.lit("").alias("unit_prefix"), "id")
    one, two = (sorted(r.id for r in profile.stable_sample(d, 20).collect()) for d in (df, df.repartition(7)))
    assert one == two and len(one) == 20 and one != list(range(20))
    assert one != sorted(r.id for r in profile.stable_sample(df, 20, seed=1).collect())


def test_card(spark):
    stats = [{"config": "compose", "rows": 5, "bytes": 10**9}, {"config": "new", "rows": 1, "bytes": 0}, {"config": "helm_chart", "rows": 1000, "bytes": 0}]
    text = card.table(stats)
    assert text.index("helm_chart") < text.index("compose") < text.index("new") and "1,006" in text and "1.00 GB" in text
    assert card.render("{{A}} {{ b }}", {"A": "x"}) == "x {{ b }}"
    with pytest.raises(KeyError, match="B"):
        card.render("{{A}}{{B}}", {"A": "x"})
    with pytest.warns(UserWarning, match="C"):
        card.render("{{A}}", {"A": "x", "C": "y"})
    ordered = card.in_order(spark.createDataFrame([("new",), ("compose",), ("helm_chart",)], "config string"))
    assert [r.config for r in ordered.collect()] == ["helm_chart", "compose", "new"]


def test_command_line(spark, tmp_path):
    """From a corpus to a card, one command after another."""
    from lodestone.__main__ import main

    source, out = f"{tmp_path}/c", str(tmp_path / "out")
    make_corpus(spark, source)
    main(["scan", source, "--out", f"{out}/scan"])
    assert spark.read.json(f"{out}/scan/tools").where("tool = 'dockerfile'").first().files == 3
    main(["extract", source, "--out", out, "--run-tag", "a"])
    main(["finalize", f"{out}/run=a/unit_type=dockerfile", "--config", "dockerfile", "--out", f"{out}/final"])
    main(["publish", f"{out}/final/dockerfile", "--config", "dockerfile", "--out", out])
    assert spark.read.parquet(f"{out}/data/dockerfile").where("flags.uses_latest_tag").count() == 2  # the third is a fork
    main(["summary", f"{out}/final/dockerfile", "--config", "dockerfile", "--out", f"{out}/s", "--sample", "1", "--samples", f"{out}/folders"])
    assert len(list((tmp_path / "out/folders").rglob("Dockerfile"))) == 1 == len(list((tmp_path / "out/folders").rglob("_provenance.json")))
    (tmp_path / "t.md").write_text("{{TOTAL_UNITS}}\n{{CONFIGS_TABLE}}")
    main(["card", f"{tmp_path}/t.md", "--out", out])
    assert (tmp_path / "out/README.md").read_text().startswith("2\n| config")
