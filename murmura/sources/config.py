"""Lexicon and domain files: YAML of either dialect, wherever Spark can read, and which file belongs to a domain."""
from __future__ import annotations

import posixpath

import yaml
from pyspark.sql import DataFrame, SparkSession

from murmura.operators.lexicon import SCHEMA

UNNAMED, L1 = "unnamed", "_L1"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def text(spark: SparkSession, path: str) -> str:
    """A whole small file."""
    row = spark.read.text(path, wholetext=True).first()
    return row[0].removeprefix("﻿") if row else ""


def lines(spark: SparkSession, path: str) -> list[str]:
    """The terms of a text file: trimmed lines without comments."""
    return [t for t in (x.split("#")[0].strip() for x in text(spark, path).splitlines()) if t]


def lexicon(spark: SparkSession, path: str, domain: str | None = None) -> DataFrame:
    """A lexicon file as a table of domain, l1, l2, term, ord.

    `aspects:` lists {l1, l2: {name: [terms] or the path of a term file}}, a relative path being one from the file's
    folder. `l1:` lists {name, aliases, l2: [{name, terms}]}; aliases are terms of the virtual l2 _L1. What has no name is
    called unnamed; a file with neither key is refused."""
    spec = yaml.safe_load(text(spark, path)) or {}
    name = domain or spec.get("domain") or "unknown"
    rows: list[tuple[str, str, str]] = []
    if "aspects" in spec:
        for group in spec["aspects"] or []:
            for l2, terms in (group.get("l2") or {}).items():
                if isinstance(terms, str):
                    terms = lines(spark, terms if terms.startswith("/") or "://" in terms else posixpath.join(posixpath.dirname(path), terms))
                rows += [(str(group.get("l1") or UNNAMED), str(l2), str(t)) for t in terms or []]
    elif "l1" in spec:
        for group in spec["l1"] or []:
            top = str(group.get("name") or group.get("l1") or UNNAMED)
            rows += [(top, L1, str(t)) for t in group.get("aliases") or []]
            for part in group.get("l2") or []:
                rows += [(top, str(part.get("name") or UNNAMED), str(t)) for t in part.get("terms") or []]
    else:
        raise KeyError(f"{path} has neither aspects nor l1")
    return spark.createDataFrame([(name, *r, i) for i, r in enumerate(rows)], SCHEMA)


def resolve(spark: SparkSession, root: str, domain: str) -> tuple[str, str]:
    """The paths of a domain's aspects and domain files: in the domain's own folder, or beside each other as in the old layout."""
    name = domain.strip().lower()
    if not name:
        raise ValueError("no domain is given")
    found = []
    for kind in ("aspects", "domain"):
        places = (f"{root}/domains/{name}/{kind}.yaml", f"{root}/{kind}_{name}.yaml")
        found.append(next((p for p in places if exists(spark, p)), None))
    missing = [k for k, p in zip(("aspects", "domain"), found) if p is None]
    if missing:
        raise FileNotFoundError(f"{name} has no {' and no '.join(missing)} file below {root}")
    return found[0], found[1]


def out_of_step(spark: SparkSession, root: str, domain: str) -> list[str]:
    """Files of the old layout that differ from those of the domain's folder, or aren't there; line ends don't count."""
    plain = lambda p: "\n".join(x.rstrip() for x in text(spark, p).splitlines()).strip()
    out = []
    for kind in ("aspects", "domain"):
        new, old = f"{root}/domains/{domain}/{kind}.yaml", f"{root}/{kind}_{domain}.yaml"
        if exists(spark, new) and (not exists(spark, old) or plain(new) != plain(old)):
            out.append(old)
    return out
