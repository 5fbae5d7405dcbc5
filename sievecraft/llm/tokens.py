"""Token ids by a tokenizers file, and the pieces that long documents are cut into.

The ids are those of the ``tokenizers`` library.  For a byte-level BPE file whose ids are its merge ranks, ``tiktoken``
gives the same ids several times faster; it takes the texts of well-known characters without special tokens, and the
library itself takes the rest.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters on whose classes all Unicode versions and engines agree: Latin, punctuation, currency.
_PLAIN = re.compile("[\\t-\\r\\x20-\\x7e\\xa0-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]*")
_GPT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level BPE files: printable Latin-1 as is, the rest from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Tokens:
    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        self.specials = [t["content"] for t in added]
        self.size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in added)]) if isinstance(spec["model"].get("vocab"), dict) else self.library.get_vocab_size()
        self.fast = self._fast(spec)

    @cached_property
    def library(self):
        """The library's own tokenizer, loaded where it is first needed; it takes far more memory than the faster one."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _fast(self, spec: dict):
        """The faster encoder, where the file is of the kind for which it gives the same ids; else None."""
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or model.get("dropout"):
            return None
        import tiktoken

        byte = _byte_characters()
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merges]
        if ids != sorted(ids) or len(set(ids)) != len(ids):
            return None
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.specials}
        return tiktoken.Encoding("file", pat_str=_GPT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and len(text) < 900_000 and _PLAIN.fullmatch(text) and not any(s in text for s in self.specials):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


_LOADED: dict[str, Tokens] = {}


def loaded(path: str | None) -> Tokens:
    """The tokenizer, loaded once a worker."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    return _LOADED[path]


def cuts(n: int, most: int) -> list[int]:
    """Where the pieces of n ids begin, and n: one piece up to ``most``, else full pieces but for the first."""
    first = n if n <= most else n % most or most
    return [0, *range(first, n + 1, most)] if n else [0]


def pieces(docs: DataFrame, most: int = 1024, end_id: int = 2, path: str | None = None, with_ids: bool = False, narrow: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (of unsigned 32-bit ids; and ids, 16-bit if ``narrow`` and possible) of every document's pieces.

    Ids of documents are text here, as pandas would make numbers with nulls among them inexact.  A null or empty text is
    its end id alone.  Rows that repeat give their pieces each.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = loaded(path)
        end = np.array([end_id], np.uint32)
        kept = "<u2" if narrow and tokens.size <= 1 << 16 else "<u4"
        for frame in frames:
            out: list[tuple] = []
            for doc, text in zip(frame["doc_id"], frame["text"]):
                ids = np.concatenate((tokens.encode(text), end)).astype("<u4", copy=False)
                at = cuts(len(ids), most)
                for k, (a, b) in enumerate(zip(at, at[1:])):
                    raw = ids[a:b].tobytes()
                    out.append((doc, k, a, b - a, zlib.crc32(raw), ids[a:b].astype(kept).tobytes()) if with_ids else (doc, k, a, b - a, zlib.crc32(raw)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(run, "doc_id string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
