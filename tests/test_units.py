"""Units, labels, candidates, gates and the steps after them, on small repositories."""

from pyspark.sql import functions as F

from lodestone.operators import candidates as cand
from lodestone.operators import finalize, gates
from lodestone.operators.resolve import labelled
from lodestone.operators.units import detect_units

SCHEMA = "repo_path string, commit_id string, stars bigint, shard int, pos int, file_path string, language string, license_type string, detected_licenses array<string>, content string"
MANIFEST = "apiVersion: v1\nkind: Pod\nkind: Extra\n"


def corpus(spark, repos):
    rows = []
    for repo, files in repos.items():
        for pos, entry in enumerate(files):
            path, content = entry if isinstance(entry, tuple) else (entry, "")
            rows.append((repo, "c", 3, 1, pos, path, None, "permissive", [], content))
    return spark.createDataFrame(rows, SCHEMA)


def test_detect_units(spark):
    files = corpus(spark, {
        "chart": ["a/Chart.yaml", "a/values.yaml", "a/templates/x.yaml"],
        "umbrella": ["a/Chart.yaml"],
        "one": ["m/main.tf"],
        "three": ["m/a.tf", "m/b.tf", "m/c.tf"],
        "roles": ["roles/a/tasks/main.yml", "x/roles/b/handlers/y.yaml", "site.yml"],
        "sub": ["a/Chart.yaml", "a/templates/x.yaml", "a/charts/b/Chart.yaml", "charts/a/charts/b/Chart.yaml"],
        "root": ["Chart.yaml", "templates/x.yaml"],
        "twice": ["m/main.tf", "m/main.tf"],
        "other": ["docker-compose.yml", "k/kustomization.yaml"],
    })
    got = {}
    for r in detect_units(files).collect():
        got.setdefault(r.repo_path, set()).add((r.unit_kind, r.prefix))
    assert got["chart"] == {("helm_chart", "a"), ("helm_chart_with_values", "a")}
    assert got["umbrella"] == {("helm_umbrella", "a")}
    assert got["one"] == {("terraform_dir", "m")} and got["three"] == {("terraform_dir", "m"), ("terraform_module", "m")}
    assert got["roles"] == {("ansible_role", "roles/a"), ("ansible_role", "x/roles/b")}
    assert got["sub"] == {("helm_chart", "a"), ("helm_umbrella", "a/charts/b")}
    assert got["root"] == {("helm_chart", "")}
    assert ("terraform_module", "m") in got["twice"]
    assert got["other"] == {("compose_project", ""), ("kustomize_dir", "k")}


def test_labels(spark):
    files = corpus(spark, {
        "r": [
            ("a/Chart.yaml", "name: x\nversion: 1\n"), ("a/values-dev.yaml", "x: 1"), ("a/templates/_h.tpl", "x"), ("a/charts/b/Chart.yaml", ""), ("a/charts/b/values.yaml", ""), ("a/README.md", ""),
            ("roles/w/tasks/main.yml", ""), ("roles/w/vars/v.yml", ""), ("roles/w/templates/t.j2", "{{ x }}"), ("misc/x.yaml", MANIFEST), ("k8s/plain.yaml", "a: 1"), ("k8s/none.yaml", None),
            (".github/workflows/e.yml", "x: 1"), ("main.tf", None), ("vendor/x.yaml", MANIFEST), ("docker-compose.yml", "services:\n  a:\n    image: b\n"),
        ]
    })
    got = {r.file_path: (r.tool, r.precision, r.evidence, r.unit) for r in labelled(files).collect()}
    context = lambda tool, unit: (tool, "structural", "context", unit)
    assert got["a/Chart.yaml"] == got["a/values-dev.yaml"] == got["a/templates/_h.tpl"] == context("helm", "a")
    assert got["a/charts/b/values.yaml"] == context("helm", "a/charts/b") or got["a/charts/b/values.yaml"] == context("helm", "a")
    assert got["a/README.md"] == (None, None, None, None)
    assert got["roles/w/vars/v.yml"] == got["roles/w/templates/t.j2"] == context("ansible", "roles/w")
    assert got["misc/x.yaml"] == got["vendor/x.yaml"] == ("kubernetes", "exact", "content", None)
    assert got["k8s/plain.yaml"] == (None, None, None, None)
    assert got["k8s/none.yaml"] == ("kubernetes", "heuristic", "path", None)
    assert got[".github/workflows/e.yml"] == ("github_actions", "structural", "path", None)
    assert got["main.tf"] == ("terraform", "exact", "path", None)
    assert got["docker-compose.yml"] == ("compose", "exact", "path+content", None)


def verdicts(spark, repos):
    files = corpus(spark, repos)
    members = cand.candidates(files, labelled(files))
    facts = gates.file_facts(files, members)
    return files, members, facts, {(r.repo_path, r.unit_type, r.prefix): r.reason for r in gates.all_verdicts(members, facts).collect()}


def test_gates(spark):
    chart = ("a/Chart.yaml", "name: x\nversion: 1\n")
    t = lambda n, body="{{ .x }}": (f"a/templates/{n}.yaml", body)
    tf = "resource \"a\" \"b\" {\n}\n"
    repos = {
        "good": [chart, ("a/values.yaml", "x: 1"), t(1), t(2)],
        "few": [chart, t(1)],
        "bad": [("a/Chart.yaml", "name: [x"), t(1), t(2)],
        "untemplated": [chart, t(1, "x: 1"), t(2, "x: 1")],
        "large": [chart, t(1), t(2, "{{ " + "x" * 262_200)],
        "many": [chart, *[t(i) for i in range(61)]],
        "heavy": [chart, *[t(i, "{{ " + "é" * 200_000) for i in range(7)]],
        "tf": [("m/a.tf", tf), ("m/variables.tf", tf)],
        "undeclared": [("m/a.tf", "x"), ("m/b.tf", "y")],
        "generated": [("m/a.tf", "# auto-generated\n" + tf), ("m/b.tf", "# auto-generated\n" + tf)],
        "role": [("roles/w/tasks/main.yml", "- name: a\n  shell: b\n"), ("roles/w/defaults/main.yml", "a: 1")],
        "untasked": [("roles/w/defaults/main.yml", "a: 1")],
        "unverified": [("roles/w/tasks/main.yml", "a: 1")],
        "set": [("k/a.yaml", MANIFEST), ("k/b.yaml", "apiVersion: v1\nkind: Job\n")],
        "broken": [("k/a.yaml", MANIFEST), ("k/b.yaml", "apiVersion: v1\nkind: Job\nx: [\n")],
        "docker": [("Dockerfile", "FROM a\nRUN b\nFROM c\nuser d\nHEALTHCHECK x\n"), ("b/Dockerfile", "x"), ("c/Dockerfile", "# generated by x\nFROM a\n")],
        "flow": [(".github/workflows/a.yml", "on: push\njobs:\n  a:\n    steps: []\n"), (".github/workflows/b.yml", "x: 1")],
        "compose": [("compose.yml", "services:\n  a:\n    image: b\n"), ("x/compose.yml", "services: 1")],
    }
    files, members, facts, got = verdicts(spark, repos)
    helm = {r: got[r, "helm_chart", "a"] for r in list(repos)[:7]}
    assert helm == {"good": "", "few": "too_few_templates", "bad": "unparseable_chart_metadata", "untemplated": "no_templating", "large": "file_too_large", "many": "too_many_files", "heavy": "unit_too_large"}
    assert [got[r, "terraform_module", "m"] for r in ("tf", "undeclared", "generated")] == ["", "no_declarations", "generated"]
    assert [got[r, "ansible_role", "roles/w"] for r in ("role", "untasked", "unverified")] == ["", "no_tasks", "unverified_tasks"]
    assert [got[r, "manifest_set", "k"] for r in ("set", "broken")] == ["", "too_few_manifests"]
    assert [got["docker", "dockerfile", p] for p in ("Dockerfile", "b/Dockerfile", "c/Dockerfile")] == ["", "not_a_dockerfile", "generated"]
    assert [got["flow", "workflow", f".github/workflows/{x}.yml"] for x in "ab"] == ["", "unverified_workflow"]
    assert got["compose", "compose", "compose.yml"] == "" and got["compose", "compose", "x/compose.yml"] == "unverified_compose"
    q = gates.gate_dockerfile(members, facts).where("passed").first().quality
    assert (q.stages, q.multi_stage, q.instructions, q.has_user, q.has_healthcheck, q.files) == (2, True, 3, True, True, 1)
    q = gates.gate_manifest_set(members, facts).where("passed").first().quality
    assert (q.manifests, q.kinds) == (2, ["Extra", "Job", "Pod"])
    record = gates.unit_records(files, members, gates.gate_helm_chart(members, facts)).first()
    assert [f.path for f in record.files][:2] == ["a/Chart.yaml", "a/values.yaml"] and record.license_types == ["permissive"] and record.files[0].size_bytes == len(chart[1])


UNIT = "unit_type string, repo_path string, unit_prefix string, license_types array<string>, files array<struct<path: string, content: string>>"


def test_finalize(spark):
    t = ("c/templates/a.yaml", "{{ include \"x\" }}")
    rows = [
        ("helm_chart", "r1", "c", ["permissive"], [t, ("c/templates/b.yaml", "x"), t, ("c/templates/a.yaml", "other"), (None, ""), ("", None)]),
        ("helm_chart", "r2", "c", [], [t, t]),
        ("helm_chart", "gone", "c", ["permissive", "x"], [t, ("c/templates/b.yaml", "{{ define \"x\" }}")]),
    ]
    units = spark.createDataFrame(rows, UNIT)
    got = {r.repo_path: r for r in finalize.finalized(units, "helm_chart", spark.createDataFrame([("r1",), ("r2",)], "repo_path string")).collect()}
    assert set(got) == {"r1", "r2"}
    assert [f.path for f in got["r1"].files] == ["c/templates/a.yaml", "c/templates/b.yaml", "c/templates/a.yaml", None] and got["r1"].removed == 2
    assert got["r1"].quality.templates == 3 and got["r1"].reason == "" and got["r2"].reason == "too_few_templates"
    assert (got["r1"].flags.self_contained, got["r1"].flags.references_helpers, got["r1"].flags.all_permissive, got["r2"].flags.all_permissive) == (False, True, True, False)
    stats = finalize.finalize_stats(units, "helm_chart", spark.createDataFrame([("r1",), ("r2",)], "repo_path string")).first().asDict()
    assert stats == {"unit_type": "helm_chart", "read": 3, "unparseable": 0, "dropped_opted_out": 1, "units_with_duplicates": 2, "duplicate_files_removed": 3, "dropped_after_dedup": 1, "charts_not_self_contained": 1, "written": 1}
    assert finalize.finalized(units, "helm_chart").count() == 3


def test_single_file_flags(spark):
    rows = [("FROM a@sha256:1\n", True, False), ("from a:latest\n", False, True), ("FROM a:latest-x\nRUN", False, True), ("FROM a:1", False, False)]
    df = spark.createDataFrame([(c, ["x"]) for c, _, _ in rows], "c string, license_types array<string>").withColumn("files", F.array(F.struct(F.col("c").alias("content"))))
    assert [(r.f.pins_digest, r.f.uses_latest_tag) for r in df.select(finalize.flags("dockerfile").alias("f")).collect()] == [x[1:] for x in rows]
    uses = [("uses: a/b@v4\n", True), ("uses: a/b@main", True), ("uses: a/b@0123abc\n", False), ("uses: a/b@v4.1\n", False)]
    df = spark.createDataFrame([(c, ["x"]) for c, _ in uses], "c string, license_types array<string>").withColumn("files", F.array(F.struct(F.col("c").alias("content"))))
    assert [r.f.has_unpinned_action for r in df.select(finalize.flags("workflow").alias("f")).collect()] == [x for _, x in uses]
