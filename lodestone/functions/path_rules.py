"""Which tool a file belongs to, by its path: an ordered rule table compiled to one CASE expression."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dialect import Pattern, first_of, quoted

SEGMENT = r"(^|/)"
YAML = r"\.ya?ml"


@dataclass(frozen=True)
class PathRule:
    tool: str
    precision: str
    pattern: Pattern
    languages: tuple[str, ...] = field(default=())


def _ends(tool: str, *extensions: str, precision: str = "exact", languages: tuple[str, ...] = ()) -> PathRule:
    return PathRule(tool, precision, Pattern(rf"\.({'|'.join(extensions)})$", "i"), languages)


def _named(tool: str, name: str, tail: str = "", precision: str = "exact") -> PathRule:
    """The whole base name, as a pattern, with a tail such as YAML."""
    return PathRule(tool, precision, Pattern(f"{SEGMENT}{name}{tail}$", "i"))


def _starts(tool: str, name: str, tail: str = "", precision: str = "exact") -> PathRule:
    return _named(tool, f"{name}[^/]*", tail, precision)


def _child(tool: str, directory: str, tail: str = "", precision: str = "exact") -> PathRule:
    return _named(tool, f"{directory}/[^/]+", tail, precision)


def _below(tool: str, directory: str, tail: str, precision: str) -> PathRule:
    return _named(tool, f"{directory}/.+", tail, precision)


# The tools, their order, what matches them and how far each is to be trusted.
CORE: list[PathRule] = [
    _child("github_actions", r"\.github/workflows", YAML),
    _named("github_actions", r"\.github/actions/[^/]*action", YAML),
    _starts("gitlab_ci", r"\.gitlab-ci", YAML),
    _below("gitlab_ci", r"\.gitlab/ci", YAML, "structural"),
    _starts("jenkins", "Jenkinsfile"),
    _child("circleci", r"\.circleci", YAML),
    _starts("azure_pipelines", "azure-pipelines", YAML),
    _named("drone", r"\.drone", YAML),
    _child("buildkite", r"\.buildkite", YAML),
    _named("travis", r"\.travis", YAML),
    _starts("codebuild", "buildspec", YAML),
    _child("tekton", r"\.tekton", YAML, "structural"),
    _ends("packer", r"pkr\.hcl", r"pkr\.json"),
    _ends("terraform", "tf"),
    _ends("terraform", "tfvars", r"tfvars\.json"),
    _ends("terraform", r"tf\.json"),
    _named("terragrunt", r"terragrunt\.hcl"),
    _named("helm", "Chart", YAML),
    _child("helm", "templates", r"\.tpl", "structural"),
    _named("kustomize", "kustomization", YAML),
    _named("skaffold", "skaffold", YAML),
    _starts("helmfile", "helmfile", YAML),
    _starts("compose", "(docker-)?compose", YAML),
    _starts("dockerfile", "(Dockerfile|Containerfile)"),
    _ends("dockerfile", "dockerfile", "containerfile"),
    _child("ansible", "roles/[^/]+/(tasks|handlers|defaults|vars|meta)", YAML, "structural"),
    PathRule("ansible", "structural", Pattern(f"{SEGMENT}(group_vars|host_vars)/[^/]+", "i")),
    _named("ansible", "(site|playbooks?|provision)(-[^/]*)?", YAML, "heuristic"),
    _named("ansible", r"ansible\.cfg"),
    _named("ansible", r"(inventory|hosts)(\.(ini|ya?ml))?", "", "heuristic"),
    _ends("puppet", "pp", languages=("Puppet",)),
    _child("chef", "(recipes|attributes|libraries)", r"\.rb", "structural"),
    _named("chef", r"metadata\.rb"),
    _ends("salt", "sls"),
    _ends("nix", "nix"),
    _ends("rego", "rego"),
    _ends("jsonnet", "jsonnet", "libsonnet"),
    _ends("cue", "cue"),
    _named("bazel", r"(BUILD|WORKSPACE|MODULE)(\.bazel)?"),
    _ends("bazel", "bzl"),
    _starts("pulumi", "Pulumi", YAML),
    _below("cloudformation", "(cloudformation|cfn)", r"\.(ya?ml|json)", "heuristic"),
    _named("serverless", "serverless", YAML),
    _named("sam", "template", YAML, "heuristic"),
    _named("cdk", "cdk", YAML, "heuristic"),
    _named("vagrant", "Vagrantfile"),
    _starts("cloud_init", "(cloud-init|user-data)", "", "heuristic"),
    _ends("systemd", "service", "timer", "socket", "mount", "target", "path"),
    _starts("nginx", "nginx", r"\.conf"),
    _child("nginx", r"(sites-available|sites-enabled|conf\.d)", "", "heuristic"),
    _starts("haproxy", "haproxy", r"\.cfg"),
    _starts("envoy", "envoy", YAML),
    _starts("traefik", "traefik", YAML),
    _starts("prometheus", "(prometheus|alertmanager)", YAML),
    _named("prometheus", "[^/]*(rules|alerts)[^/]*", YAML, "heuristic"),
    _child("grafana", "(dashboards|grafana)", r"\.json", "heuristic"),
    _starts("otel", "otel", YAML),
    _below("kubernetes", "(k8s|kube|kubernetes|manifests?|deploy(ment)?s?|charts?)", YAML, "heuristic"),
    _child("kubernetes", "templates", YAML, "heuristic"),
]

ADJACENT: list[PathRule] = [
    _starts("makefile", "(GNUmakefile|Makefile)"),
    _ends("shell", "sh", "bash", "zsh"),
    _named("justfile", "Justfile"),
    _named("earthly", "Earthfile"),
]

CORE_TOOLS = sorted({r.tool for r in CORE})
ADJACENT_TOOLS = sorted({r.tool for r in ADJACENT})

# Directories that hold others' or generated files.
NOISE_DIRECTORIES = [r"\.terraform", r"\.terragrunt-cache", "node_modules", "vendor", "third_party", "site-packages", r"\.git", "dist", "target", "charts/[^/]+/charts"]
NOISE = Pattern(f"{SEGMENT}({'|'.join(NOISE_DIRECTORIES)})/", "i")

# What the sizing scan looks at before its rules, and what unit detection does.
SCAN_EXTENSIONS = ["tf", "tfvars", "hcl", r"ya?ml", "nix", "rego", "jsonnet", "libsonnet", "cue", "bzl", "pp", "sls", "sh", "bash", "zsh", "conf", "cfg", "service", "timer", "socket", "mount", "target", "path", "tpl", "rb", "json", "dockerfile", "containerfile"]
SCAN_NAMES = ["Dockerfile", "Containerfile", "Makefile", "GNUmakefile", "Jenkinsfile", "Vagrantfile", "BUILD", "WORKSPACE", "MODULE", "Justfile", "Earthfile", "ansible", "inventory", "hosts"]
SCAN_PREFILTER = Pattern(rf"\.({'|'.join(SCAN_EXTENSIONS)})$|{SEGMENT}({'|'.join(SCAN_NAMES)})[^/]*$", "i")
UNIT_PREFILTER = Pattern(rf"Chart{YAML}|values[^/]*{YAML}|kustomization{YAML}|compose[^/]*{YAML}|\.tf$|templates/|roles/", "i")

YAML_FILE = Pattern(rf"{YAML}$", "i")
YAML_OR_TEMPLATE = Pattern(r"\.(ya?ml|tpl)$", "i")
LICENSE_FILE = Pattern(r"\A(LICEN[SC]E|COPYING|COPYRIGHT|UNLICENSE|NOTICE)(\.(md|txt|rst))?\z", "i")


def classify(path: Column, language: Column | None = None, rules: list[PathRule] | None = None) -> Column:
    """struct(tool, precision) of the first rule that matches; null for none, and for noise."""
    cases = []
    for rule in rules if rules is not None else CORE + ADJACENT:
        holds = rule.pattern.found(path)
        if rule.languages:
            holds = holds & (F.coalesce(language, F.lit("")) if language is not None else F.lit("")).isin(*rule.languages)
        cases.append((holds, F.struct(F.lit(rule.tool).alias("tool"), F.lit(rule.precision).alias("precision"))))
    return F.when(~NOISE.found(path), first_of(cases))


def classify_sql(path: str, language: str, field_name: str) -> str:
    """The same as a SQL expression of one of its fields."""
    lines = []
    for rule in CORE + ADJACENT:
        holds = rule.pattern.sql(path)
        if rule.languages:
            holds += f" AND coalesce({language}, '') IN ({', '.join(map(quoted, rule.languages))})"
        lines.append(f"WHEN {holds} THEN {quoted(getattr(rule, field_name))}")
    return f"CASE WHEN {NOISE.sql(path)} THEN NULL {' '.join(lines)} END"
