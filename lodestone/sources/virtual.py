"""A corpus derived from the `documents` table: 48 consecutive documents make a repository, and each has a fixed place in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import quoted

PER_REPO = 48

_CHART = "name: demo\nversion: 1.0.0\n"
_TEMPLATE = "apiVersion: v1\nkind: Service\nmetadata:\n  name: {{ .Values.name }}\n"
_MANIFEST = "apiVersion: apps/v1\nkind: Deployment\nmetadata:\n  name: web\n"
_CONFIG = "apiVersion: v1\nkind: ConfigMap\nmetadata:\n  name: settings\n"
_TASKS = "- name: install\n  package:\n    name: nginx\n  become: true\n"
_WORKFLOW = "on:\n  push:\njobs:\n  build:\n    runs-on: ubuntu\n    steps:\n      - uses: actions/checkout@v4\n      - run: make\n"
_COMPOSE = "services:\n  web:\n    image: nginx\n    volumes: [data]\nvolumes:\n  data:\n"
_DOCKER = "FROM alpine:latest AS build\nRUN make\nFROM scratch\nCOPY --from=build /out /out\nUSER app\n"
_TF = 'resource "null_resource" "a" {\n}\n'

#: (path, language, head, body): body "comment" puts the text behind # on each line, "none" leaves it out, "plain" appends it.
SLOTS: list[tuple[str, str, str, str]] = [
    ("chart/Chart.yaml", "YAML", _CHART, "comment"),
    ("chart/values.yaml", "YAML", "image: nginx\nreplicaCount: 2\n", "comment"),
    ("chart/templates/service.yaml", "YAML", _TEMPLATE, "comment"),
    ("chart/templates/deployment.yaml", "YAML", _TEMPLATE, "comment"),
    ("chart/templates/extra.yaml", "YAML", '{{ include "demo.name" . }}\n', "comment"),
    ("chart/templates/_helpers.tpl", "Smarty", '{{- define "demo.name" -}}demo{{- end -}}\n', "comment"),
    ("chart/charts/sub/Chart.yaml", "YAML", _CHART, "none"),
    ("chart/charts/sub/templates/service.yaml", "YAML", _TEMPLATE, "none"),
    ("roles/web/tasks/main.yml", "YAML", _TASKS, "comment"),
    ("roles/web/defaults/main.yml", "YAML", "port: 80\n", "comment"),
    ("roles/web/templates/site.conf.j2", "Jinja", "listen {{ port }};\n", "plain"),
    ("site.yml", "YAML", "- hosts: all\n  roles:\n    - web\n", "comment"),
    ("infra/main.tf", "HCL", _TF, "comment"),
    ("infra/variables.tf", "HCL", 'variable "name" {\n}\n', "comment"),
    ("infra/outputs.tf", "HCL", 'output "id" {\n}\n', "comment"),
    ("single/main.tf", "HCL", _TF, "comment"),
    ("k8s/app.yaml", "YAML", _MANIFEST, "comment"),
    ("k8s/config.yaml", "YAML", _CONFIG, "comment"),
    ("misc/odd.yaml", "YAML", _MANIFEST, "comment"),
    ("misc/notes.yaml", "YAML", "title: notes\n", "comment"),
    (".github/workflows/ci.yml", "YAML", _WORKFLOW, "comment"),
    (".github/workflows/empty.yml", "YAML", "", "comment"),
    ("docker-compose.yml", "YAML", _COMPOSE, "comment"),
    ("Dockerfile", "Dockerfile", _DOCKER, "comment"),
    ("build/Dockerfile", "Dockerfile", "# DO NOT EDIT\nFROM alpine\n", "comment"),
    ("app/Dockerfile.dev", "Dockerfile", "nothing here\n", "plain"),
    (".gitlab-ci.yml", "YAML", "stages: [test]\njob:\n  script: make\n", "comment"),
    ("Jenkinsfile", "Groovy", "pipeline {}\n", "plain"),
    ("kustomize/kustomization.yaml", "YAML", "resources: [a.yaml]\n", "comment"),
    ("rules/alerts.yml", "YAML", "groups:\n  - name: a\n    rules:\n      - alert: Down\n", "comment"),
    ("cloudformation/stack.yaml", "YAML", "AWSTemplateFormatVersion: '2010-09-09'\nResources:\n  B:\n    Type: AWS::S3::Bucket\n", "comment"),
    ("api/openapi.yaml", "YAML", "openapi: 3.0.0\n", "comment"),
    ("modules/site.pp", "Puppet", "class web {}\n", "plain"),
    ("src/other.pp", "Pascal", "unit other;\n", "plain"),
    ("default.nix", "Nix", "{ }: { }\n", "plain"),
    ("Makefile", "Makefile", "all:\n\ttrue\n", "plain"),
    ("scripts/run.sh", "Shell", "#!/bin/sh\n", "plain"),
    ("vendor/lib/deploy/app.yaml", "YAML", _MANIFEST, "comment"),
    ("node_modules/x/Dockerfile", "Dockerfile", _DOCKER, "comment"),
    ("LICENSE", "Text", "", "plain"),
    ("src/main.py", "Python", "print(1)\n", "plain"),
    ("src/util.go", "Go", "package util\n", "plain"),
    ("README.md", "Markdown", "# Demo\n", "plain"),
    ("src/App.java", "Java", "class App {}\n", "plain"),
    ("web/index.html", "HTML", "<html>\n", "plain"),
    ("group_vars/all", "", "env: prod\n", "plain"),
    ("conf.d/site", "", "server {}\n", "plain"),
    ("docs/guide.txt", "Text", "", "plain"),
]

LICENSE_LINE = "(Apache License|MIT License|SPDX-License-Identifier)"


def virtual_files(spark: SparkSession, sf_dir: str, content: bool = True, repeats: bool = False) -> DataFrame:
    """The derived file table. Without content, only numbers are read. repeats adds every seventh slot once more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slots = spark.createDataFrame([(i, *s) for i, s in enumerate(SLOTS)], "slot bigint, file_path string, language string, head string, body string")
    rows = docs.withColumn("repo_idx", F.floor(F.col("doc_id") / PER_REPO)).withColumn("slot", F.col("doc_id") % PER_REPO)
    rows = rows.join(F.broadcast(slots), "slot")  # 48 rows
    gone = ((F.col("repo_idx") % 3 == 1) & (F.col("slot") == 0)) | ((F.col("repo_idx") % 3 == 2) & F.col("slot").between(2, 5))
    rows = rows.where(~gone)
    commented = F.concat(F.lit("# "), F.replace(F.col("text"), F.lit("\n"), F.lit("\n# ")))
    whole = F.concat("head", F.when(F.col("body") == "plain", F.col("text")).when(F.col("body") == "comment", commented).otherwise(""))
    permissive = F.col("text").rlike(LICENSE_LINE)
    columns = [
        F.concat(F.lit("org"), F.col("repo_idx") % 5, F.lit("/repo"), F.col("repo_idx")).alias("repo_path"),
        F.concat(F.lit("c"), F.col("repo_idx")).alias("commit_id"),
        ((F.col("repo_idx") * 7919) % 20000).cast("bigint").alias("stars"),
        (F.col("repo_idx") % 11 == 10).alias("is_fork"),
        (F.col("repo_idx") % 8).cast("int").alias("shard"),
        F.col("slot").cast("int").alias("pos"),
        "file_path",
        "language",
        F.col("n_chars").alias("size_bytes"),
        F.when(permissive, "permissive").otherwise("no_license").alias("license_type"),
        F.lit(False).alias("is_vendor"),
        F.when(permissive, F.array(F.lit("detected"))).otherwise(F.array().cast("array<string>")).alias("detected_licenses"),
    ]
    out = rows.select(*columns, *([whole.alias("content")] if content else []))
    if repeats:
        out = out.unionAll(out.where(F.col("pos") % 7 == 0).withColumn("pos", F.col("pos") + PER_REPO))
    return out


def files_sql(repeats: bool = False) -> str:
    """The same table as SQL, to go into a WITH list as `files`."""
    values = ", ".join(f"({i}, {quoted(p)}, {quoted(lang)}, {quoted(head)}, {quoted(body)})" for i, (p, lang, head, body) in enumerate(SLOTS))
    base = f"""slots(slot, file_path, language, head, body) AS (VALUES {values}),
placed AS (SELECT doc_id // {PER_REPO} AS repo_idx, doc_id % {PER_REPO} AS slot, text, n_chars FROM documents),
base_files AS (SELECT 'org' || (repo_idx % 5) || '/repo' || repo_idx AS repo_path, 'c' || repo_idx AS commit_id, CAST((repo_idx * 7919) % 20000 AS BIGINT) AS stars,
  repo_idx % 11 = 10 AS is_fork, CAST(repo_idx % 8 AS INTEGER) AS shard, CAST(slot AS INTEGER) AS pos, file_path, language, n_chars AS size_bytes,
  CASE WHEN regexp_matches(text, '{LICENSE_LINE}') THEN 'permissive' ELSE 'no_license' END AS license_type,
  head || CASE body WHEN 'plain' THEN text WHEN 'comment' THEN '# ' || replace(text, chr(10), chr(10) || '# ') ELSE '' END AS content
  FROM placed JOIN slots USING (slot) WHERE NOT ((repo_idx % 3 = 1 AND slot = 0) OR (repo_idx % 3 = 2 AND slot BETWEEN 2 AND 5)))"""
    if repeats:
        return base + f", files AS (SELECT * FROM base_files UNION ALL SELECT * REPLACE (CAST(pos + {PER_REPO} AS INTEGER) AS pos) FROM base_files WHERE pos % 7 = 0)"
    return base + ", files AS (SELECT * FROM base_files)"
