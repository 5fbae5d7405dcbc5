"""Credential detectors for source files, as expressions; a finding is a type and a line, never the value.

The families are those that public scanners share; the patterns are our own and heuristic.  They only tell whether a line
has a match.  Two begin at the first place where a match could start in a line or run, so that a line costs its length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Type and pattern of each detector.
PATTERNS = (
    ("AWS Access Key", r"(AKIA|ASIA)[0-9A-Z]{16}"),
    ("Azure Storage Account access key", r"AccountKey=[A-Za-z0-9+/=]{88}"),
    ("Basic Auth Credentials", r"://[^:/?#@ \t\n]+:[^:/?#@ \t\n]+@"),
    ("GitHub Token", r"(ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9_]{36}"),
    ("GitLab Token", r"glpat-[A-Za-z0-9_-]{20,}"),
    ("JSON Web Token", r"(?<![A-Za-z0-9_=-])(?:(?!eyJ)[A-Za-z0-9_=-])*+eyJ[A-Za-z0-9_=-]++\.[A-Za-z0-9_=-]++\."),
    ("NPM tokens", r"(?m:^)(?:(?!//).)*+//.+/:_authToken=[A-Za-z0-9-]"),
    ("Private Key", r"BEGIN (DSA|EC|OPENSSH|PGP|RSA|SSH2 ENCRYPTED)? ?PRIVATE KEY"),
    ("PyPI Token", r"pypi-AgE[A-Za-z0-9_-]{50,}"),
    ("Secret Keyword", r"""(?i)(api_?key|auth_?key|private_?key|secret|passw(or)?d|pwd|token)["']?\]?[ \t]*(=|:|=>|:=)[ \t]*["'][^"'\s]{4,}["']"""),
    ("SendGrid API Key", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    ("Slack Token", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    ("Stripe Access Key", r"(r|s)k_live_[0-9a-zA-Z]{24}"),
    ("Twilio API Key", r"(AC|SK)[a-f0-9]{32}"),
)
#: What every match of the costlier patterns has; looked for before lines are judged one by one.
_HINTS = {"JSON Web Token": "eyJ", "NPM tokens": ":_authToken="}
_QUOTED = r"""["']([A-Za-z0-9+/=_-]{20,})["']"""
#: Type, what its strings are made of, least entropy in bits a character.
ENTROPY = (("Base64 High Entropy String", r"\A[A-Za-z0-9+/=_-]+\z", 4.5), ("Hex High Entropy String", r"\A[0-9a-fA-F]+\z", 3.0))


def entropy(text: Column) -> Column:
    """Shannon's, in bits a character; 0 for an empty text."""
    chars = F.split(text, "")
    share = lambda all_, x: (F.size(F.filter(all_, lambda y: y == x)) / F.size(all_))
    bits = F.transform(F.array(chars), lambda a: F.aggregate(F.array_distinct(a), F.lit(0.0), lambda s, x: s - share(a, x) * F.log2(share(a, x))))
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(bits[0])


def _random(pattern: str, least: float):
    return lambda q: q.rlike(pattern) & (entropy(q) >= least)


def _types(line: Column) -> Column:
    none = F.lit(None).cast("string")
    named = [F.when(line.rlike(pattern), name).otherwise(none) for name, pattern in PATTERNS]
    quoted = F.regexp_extract_all(line, F.lit(_QUOTED), F.lit(1))
    random = [F.when(F.exists(quoted, _random(pattern, least)), name).otherwise(none) for name, pattern, least in ENTROPY]
    return F.array_compact(F.array(*named, *random))


def findings(code: Column) -> Column:
    """array<struct<type, line_number>> by line, then type; lines count from 1."""
    suspect = "|".join(f"(?:{_HINTS.get(name, p)})" for name, p in PATTERNS) + f"|{_QUOTED}"
    each = F.transform(F.split(code, "\n"), lambda line, i: F.transform(F.when(line.rlike(suspect), _types(line)).otherwise(F.expr("cast(array() as array<string>)")), lambda t: F.struct(t.alias("type"), (i + 1).cast("long").alias("line_number"))))
    order = lambda a, b: F.when(a["line_number"] < b["line_number"], -1).when(a["line_number"] > b["line_number"], 1).when(a["type"] < b["type"], -1).when(a["type"] > b["type"], 1).otherwise(0)
    return F.when(code.rlike(suspect), F.array_sort(F.flatten(each), order)).otherwise(F.expr("cast(array() as array<struct<type:string,line_number:bigint>>)"))
