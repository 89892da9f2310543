"""Path rules, content detectors, scalars and the YAML facts."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.functions import detectors, scalars
from lodestone.functions.path_rules import ADJACENT, CORE, LICENSE_FILE, NOISE, classify
from lodestone.functions.yaml_facts import facts

PATHS = [
    (".github/workflows/build.yaml", None, "github_actions", "exact"),
    ("x/.github/actions/setup/action.yml", None, None, None),
    (".github/actions/setup-action.yml", None, "github_actions", "exact"),
    (".gitlab/ci/jobs/test.yml", None, "gitlab_ci", "structural"),
    ("ci/Jenkinsfile.release", None, "jenkins", "exact"),
    ("net/MAIN.TF", None, "terraform", "exact"),
    ("live/terragrunt.hcl", None, "terragrunt", "exact"),
    ("app/Chart.yml", None, "helm", "exact"),
    ("app/templates/_h.tpl", None, "helm", "structural"),
    ("docker-compose.prod.yml", None, "compose", "exact"),
    ("img/web.Dockerfile", None, "dockerfile", "exact"),
    ("roles/db/vars/x.yml", None, "ansible", "structural"),
    ("group_vars/all", None, "ansible", "structural"),
    ("hosts", None, "ansible", "heuristic"),
    ("m/init.pp", "Puppet", "puppet", "exact"),
    ("m/init.pp", "Pascal", None, None),
    ("cookbooks/a/recipes/x.rb", None, "chef", "structural"),
    ("BUILD.bazel", None, "bazel", "exact"),
    ("cfn/a/b.json", None, "cloudformation", "heuristic"),
    ("etc/app.service", None, "systemd", "exact"),
    ("mon/my-alerts-x.yml", None, "prometheus", "heuristic"),
    ("k8s/.github/workflows/a.yml", None, "github_actions", "exact"),
    ("deployments/a/b.yaml", None, "kubernetes", "heuristic"),
    ("Makefile.inc", None, "makefile", "exact"),
    ("justfile", None, "justfile", "exact"),
    ("vendor/k8s/a.yaml", None, None, None),
    ("charts/a/charts/b/Chart.yaml", None, None, None),
    ("build/Dockerfile", None, "dockerfile", "exact"),
    ("src/main.py", "Python", None, None),
]


def test_paths(spark):
    df = spark.createDataFrame([(i, p, lang) for i, (p, lang, _, _) in enumerate(PATHS)], "i int, p string, l string")
    got = {r.i: (r.t, r.q) for r in df.select("i", classify(F.col("p"), F.col("l")).alias("c")).select("i", F.col("c.tool").alias("t"), F.col("c.precision").alias("q")).collect()}
    assert got == {i: (t, q) for i, (_, _, t, q) in enumerate(PATHS)}


CONTENTS = [
    ("apiVersion: v1\nkind: Pod\n", "a.yaml", "k8s_manifest"),
    ("apiVersion: v1\nkind: Pod\nname: {{ .Values.x }}\n", "c/a.yaml", "helm_template"),
    ("{{ include \"x\" . }}\n", "c/templates/a.yaml", "helm_template"),
    ("{{ include \"x\" . }}\n", "c/other/a.yaml", "other"),
    ("x: {{ y }}\n", "roles/a/templates/x.yml", "other"),
    ("services:\n\n  # c\n  web:\n    image: a\n", "a.yml", "compose"),
    ("services:\n  - docker\n", ".travis.yml", "other"),
    ("on: push\njobs:\n  a: 1\n", "a.yml", "github_actions"),
    ("groups:\n - rules:\n   - alert: X\n", "a.yml", "prometheus_rules"),
    ("Resources:\n  A:\n    Type: AWS::S3::Bucket\n", "a.yml", "cloudformation"),
    ("- hosts: all\n  tasks: []\n", "a.yml", "ansible"),
    ("- name: x\n  become: true\n", "a.yml", "ansible"),
    ("stages: [a]\nx:\n  script: y\n", "a.yml", "gitlab_ci"),
    ("openapi: '3.0'\n", "a.yml", "openapi"),
    ("replicaCount: 1\n", "values.yaml", "helm_values"),
    ("", "a.yml", "other"),
    ("# only\n", "a.yml", "other"),
    (None, "a.yml", "other"),
    ("services:\n" + "\n" * 4000 + "  web:\n", "a.yml", "compose"),
]


def test_kinds(spark):
    df = spark.createDataFrame([(i, c, p) for i, (c, p, _) in enumerate(CONTENTS)], "i int, c string, p string")
    got = {r.i: r.k for r in df.select("i", detectors.yaml_kind(F.col("c"), F.col("p")).alias("k")).collect()}
    assert got == {i: k for i, (_, _, k) in enumerate(CONTENTS)}


def test_other_detectors(spark):
    rows = ["resource \"a\" \"b\" {", "  locals {", "resourceful x", "FROM a\nRUN b", "from a", "RUN b", "# Code Generated By x", "plain", " " * 1100 + "DO NOT EDIT"]
    c = F.col("c")
    got = [tuple(r) for r in spark.createDataFrame([(x,) for x in rows], "c string").select(detectors.is_terraform(c), detectors.is_dockerfile(c), detectors.looks_generated(c)).collect()]
    t, d, g = zip(*got, strict=True)
    assert t == (True, True, False, False, False, False, False, False, False)
    assert d == (False, False, False, True, True, False, False, False, False)
    assert g == (False, False, False, False, False, False, True, False, False)


PIECES = ["services:", "\n", "\r", "\r\n", " ", "\t", "\u00a0", "\u0085", "apiVersion:", "kind:", "- name:", "\u212a", "web:", "#", "x", "FROM a", "on:", "jobs:", "  uses:", "\u2028", "\x0b"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=8).map("".join), min_size=8, max_size=8))
def test_patterns_agree_with_python(spark, texts):
    patterns = {n: p for n, p in vars(detectors).items() if isinstance(p, detectors.Pattern)}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for row in df.select("i", "t", *[p.found(F.col("t")).alias(n) for n, p in patterns.items()]).collect():
        for n, p in patterns.items():
            flags = (re.M if "m" in p.flags else 0) | (re.I if "i" in p.flags else 0)
            assert row[n] == bool(re.search(p.body, row.t, flags)), (n, row.t)


def test_rules_compile_for_python():
    for rule in CORE + ADJACENT:
        re.compile(rule.pattern.body)
    assert re.search(NOISE.body, "a/Vendor/b", re.I) and not re.search(NOISE.body, "avendor/b", re.I)
    own = LICENSE_FILE.body.replace(r"\z", r"\Z")
    assert re.search(own, "licence.md", re.I) and not re.search(own, "LICENSE.py", re.I)


def test_scalars(spark):
    df = spark.createDataFrame([("a/b/c.txt", "a/b", 0), ("c.txt", "", 5), ("ab/c", "a", None), ("a/b/", "a", 10_000)], "p string, d string, s int")
    p = F.col("p")
    got = [tuple(r) for r in df.select(scalars.dirname(p), scalars.basename(p), scalars.relative(p, F.col("d")), scalars.star_bucket(F.col("s")), scalars.ancestors(p)).collect()]
    assert got == [("a/b", "c.txt", "c.txt", "0", ["", "a", "a/b"]), ("", "c.txt", "c.txt", "1-10", [""]), ("ab", "c", None, "0", ["", "ab"]), ("a/b", "", "b/", "10k+", ["", "a", "a/b"])]


@pytest.mark.parametrize("text", ["", "\x00", "a: b: c", "[1, 2", "@x", "!!bool test", "!!int x", "!!timestamp y", "!!binary z", "[" * 3000, None, "x" * 300_000])
def test_hostile_yaml(text):
    assert not facts(text)["is_k8s"]


def test_yaml_facts():
    flow = facts("on: [push, pull_request]\npermissions: {}\njobs:\n  a:\n    runs-on: x\n    steps:\n      - uses: y\n      - run: z\n  b: 3\n")
    assert flow["is_gha"] and (flow["jobs"], flow["steps"], flow["uses_actions"], flow["triggers"]) == (2, 2, 1, ["pull_request", "push"]) and flow["has_permissions"]
    assert facts("on: push\njobs:\n  a:\n    steps: 5\n")["steps"] == 0
    assert facts("on: push\njobs: {}\n")["is_gha"] is False and facts("jobs:\n  a:\n    steps: []\n")["is_gha"] is False
    assert facts("---\na: 1\n---\napiVersion: v1\nkind: Pod\n")["is_k8s"] and not facts("apiVersion: 1\nkind: Pod\n")["is_k8s"]
    assert facts("- name: a\n  shell: b\n")["is_ansible"] and not facts("- name: a\n")["is_ansible"]
    c = facts("services:\n  a:\n    build: .\n    healthcheck: {}\n  b: x\nnetworks: {}\n")
    assert c["is_compose"] and (c["services"], c["built_services"], c["has_healthcheck"], c["has_networks"], c["has_volumes"]) == (2, 1, True, True, False)
    assert facts("name: a\nversion: 1\n")["is_chart_meta"] and not facts("name: a\nversion: 0\n")["is_chart_meta"]
    assert facts("on: x\nb: 1\n")["top_keys"] == ["on", "b"]
