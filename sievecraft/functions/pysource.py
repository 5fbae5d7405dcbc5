"""Analysis of Python source: syntax, token count and structural fingerprint.

It needs Python's own parser and so is the one place where files pass through Python, in Arrow batches; null code (files
that a cheaper gate has rejected) is not parsed.  Results depend on the executors' Python version; see ``VERSION``.
"""

from __future__ import annotations

import ast
import hashlib
import io
import keyword
import sys
import tokenize
import warnings

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VERSION = "{}.{}".format(*sys.version_info)
#: Kinds of tokens that are not part of the structure, and those that stand for their kind.
_LAYOUT = frozenset((tokenize.ENCODING, tokenize.ENDMARKER, tokenize.NEWLINE, tokenize.NL, tokenize.INDENT, tokenize.DEDENT, tokenize.COMMENT))
_GENERAL = {tokenize.NAME: "NAME", tokenize.STRING: "STRING", tokenize.NUMBER: "NUMBER"}


def structure(code: str) -> list[str]:
    """The tokens with names, strings and numbers made general; hard keywords stay."""
    found = ((t.type, t.string) for t in tokenize.generate_tokens(io.StringIO(code).readline))
    return [s if keyword.iskeyword(s) else _GENERAL.get(kind, s) for kind, s in found if kind not in _LAYOUT]


def analyze_one(code: str, syntax_check: bool = True) -> tuple[str | None, int | None, str | None]:
    """error, tokens, structural_hash; a parser that gives up on a file is that file's error."""
    try:
        if syntax_check:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                ast.parse(code)
    except SyntaxError as e:
        return f"syntax_error:{e.msg}", None, None
    except (MemoryError, RecursionError, ValueError):
        return "parser_failure", None, None
    try:
        parts = structure(code)
    except (tokenize.TokenError, IndentationError) as e:
        return f"tokenization_error:{e}", None, None
    return None, len(parts), hashlib.sha256(" ".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def analyze(code: Column, syntax_check: bool = True) -> Column:
    @F.pandas_udf("struct<error string, tokens long, structural_hash string>")
    def run(codes: pd.Series) -> pd.DataFrame:
        rows = [(None, None, None) if c is None else analyze_one(c, syntax_check) for c in codes]
        out = pd.DataFrame(rows, columns=["error", "tokens", "structural_hash"])
        return out.astype({"tokens": "Int64"})

    # marked so that the planner neither repeats the parser nor moves filters on its results, with copies of it, below it
    return run.asNondeterministic()(code)
