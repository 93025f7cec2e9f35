"""Token counts of whole texts, with huge documents encoded in overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.shared import whole_row

TOKENIZER = "word_bpe_49k.json"

#: Bytes A-Z to a-z.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Letters that are composed already, then ASCII marks other than the apostrophe: the pre-tokenizer always parts them.
_WORD_AND_MARKS = re.compile("([a-zß-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]+)")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(name: str):
    """The library's tokenizer, once per Python worker, on this task's core alone."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


@lru_cache(maxsize=4)
def parts_at_spaces(name: str) -> bool:
    """Whether the tokenizer drops white space between pre-tokens, so that no token spans a space.

    True if its normaliser only composes, lower-cases and unifies spaces, and its first pre-tokenizer keeps matches
    of a pattern that has no space in it and drops all else. Then a text's ids are those of its space-separated words.
    """
    with open(tokenizer_path(name)) as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    pattern = first.get("pattern", {}).get("Regex", " ")
    return (
        {s["type"] for s in steps} <= {"NFC", "Lowercase", "Replace"} and all(s.get("content") == " " for s in steps if s["type"] == "Replace")
        and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and " " not in pattern and "[^\\s" in pattern
        and not any(x.get("lstrip") or x.get("rstrip") or x.get("normalized") for x in spec.get("added_tokens", []))
    )


class WordIds:
    """Ids of space-separated words, each encoded by the library when first met. Holds at most ``most`` words."""

    def __init__(self, name: str, of: Callable[[list[int]], object], most: int = 400_000) -> None:
        self.tokenizer, self.of, self.most = load(name), of, most
        self.known: dict[str, object] = {}

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        known = self.known
        new = set(words).difference(known)
        if not new:
            return
        if len(known) + len(new) > self.most:
            known.clear()
            new = set(words)
        parts = [(m[0], m[1], m[2]) for m in map(_WORD_AND_MARKS.fullmatch, new) if m]
        single = new.difference([w for w, _, _ in parts])
        single.update([a for _, a, _ in parts], [b for _, _, b in parts])
        fresh = list(single.difference(known))
        known.update(zip(fresh, map(self.of, self._encode(fresh)), strict=True))
        known.update([(w, known[a] + known[b]) for w, a, b in parts])  # type: ignore[operator]

    def words(self, text: str) -> list[str]:
        """Lower-casing early halves the words to know; a special token is matched before that, so such texts stay as they are."""
        if "<|" in text:
            return text.replace("\n", " ").split(" ")
        return text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass").replace("\n", " ").split(" ")

    def look_up(self, text: str) -> list:
        words = self.words(text)
        try:
            return list(map(self.known.__getitem__, words))
        except KeyError:
            self.learn(words)
            return list(map(self.known.__getitem__, words))


def splice(text: str, encode: Callable[[str], tuple[list[int], list[tuple[int, int]]]], chunk: int, overlap: int) -> list[int]:
    """Ids of ``text`` from chunks of ``chunk`` characters that overlap by ``overlap``.

    Each chunk is encoded with offsets. Neighbours are joined at a character where both begin a token just after
    white space, with ``overlap // 8`` characters before and after it in which both give the same tokens: a cut that the
    neighbours' ends did not disturb. Where the overlap has none, it is doubled to the right and the left chunk is
    encoded again; at the text's end the last chunk holds all that is left.
    """
    out: list[int] = []
    at, size = 0, len(text)
    while at < size:
        margin = overlap
        while True:
            to = min(size, at + chunk + margin)
            ids, spans = encode(text[at:to])
            if to == size:
                return out + ids
            nxt = min(at + chunk, to - overlap // 2)
            right_ids, right_spans = encode(text[nxt : min(size, to + overlap)])
            cut = common_boundary(text, at, ids, spans, nxt, right_ids, right_spans, to, overlap // 8)
            if cut is not None:
                k = next(i for i, (a, _) in enumerate(spans) if a + at >= cut)
                out += ids[:k]
                at = cut
                break
            margin *= 2
    return out


def common_boundary(text: str, at: int, ids: list[int], spans: list[tuple[int, int]], nxt: int, right_ids: list[int], right_spans: list[tuple[int, int]], to: int, steady: int) -> int | None:
    """The middle-most place in [nxt, to) at which the tokens of both chunks agree for ``steady`` characters on either side."""
    left = {(a + at, b + at, t) for (a, b), t in zip(spans, ids, strict=True) if nxt <= a + at and b + at <= to}
    right = {(a + nxt, b + nxt, t) for (a, b), t in zip(right_spans, right_ids, strict=True) if nxt <= a + nxt and b + nxt <= to}
    odd = sorted({a for a, _, _ in left ^ right} | {b for _, b, _ in left ^ right} | {nxt, to})
    starts = sorted({a for a, _, _ in left & right if a > 0 and text[a - 1].isspace()})
    middle = (nxt + to) / 2
    for a in sorted(starts, key=lambda a: abs(a - middle)):
        k = int(np.searchsorted(odd, a, side="right"))
        if (k == 0 or a - odd[k - 1] >= steady) and (k == len(odd) or odd[k] - a >= steady):
            return a
    return None


def encode_whole(name: str, text: str) -> tuple[list[int], list[tuple[int, int]]]:
    e = load(name).encode(text, add_special_tokens=False)
    return e.ids, e.offsets


def count_tokens(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, tokenizer: str = TOKENIZER, chunk: int = 32_768, overlap: int = 512) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, all by default), ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text.

    Texts longer than two chunks are encoded in overlapping chunks and spliced (``splice``); memory then follows the
    chunk, not the document. Others are encoded by space-separated word, each word once per worker, where the
    tokenizer provably parts texts at spaces, else whole. Null counts as empty: 0 bytes, 0 tokens. Repeated rows and
    columns of any name are carried through.
    """
    row = docs.select(*[F.col(f"`{c}`") for c in keep or docs.columns])
    schema = T.StructType([T.StructField("row", row.schema), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word = WordIds(tokenizer, len) if parts_at_spaces(tokenizer) else None
        for batch in batches:
            counts = []
            for value in batch.column("counted"):
                body = value.as_py() or ""
                if len(body) > 2 * chunk:
                    counts.append(len(splice(body, lambda s: encode_whole(tokenizer, s), chunk, overlap)))
                elif by_word:
                    counts.append(sum(by_word.look_up(body)))
                else:
                    counts.append(len(encode_whole(tokenizer, body)[0]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["row", "n_bytes", "n_tokens"])

    body = F.col(f"`{text}`").cast("string")
    return docs.select(whole_row(row), body.alias("counted"), F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes")).mapInArrow(run, schema)
