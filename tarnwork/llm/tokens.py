"""Token counts and token ids of whole texts, by a public byte-level BPE vocabulary.

Method: whole-token shortcut. Before any text is read it is proved which strings of the vocabulary encode alone as one
token; a pre-token of a text that is such a string counts one, and only the rest goes through the merges. What a run of
text between two white spaces comes to is remembered per worker, up to ``REMEMBER`` runs.

Text is cut where white space follows another character. No pre-token of the pattern crosses such a place and nothing
before it is looked at, so the pieces can be encoded alone.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import remembered, ship, text_or_empty

VOCABULARY = "byte_bpe_50k.json"
# Runs of text remembered by one worker: about 100 bytes each.
REMEMBER = 1_000_000
# Runs encoded as one text.
GROUP = 512
# Texts handled together: bounds what a worker holds besides one Arrow batch.
SLICE_CHARS = 4_000_000
# White space as the pre-token pattern of the vocabulary sees it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c))

_LOADED: dict[str, "Vocabulary"] = remembered()


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def crowded(run: str) -> bool:
    """Whether a run from behind a space has white space at an end, so that more than that space stands there. A line break
    at its front is no part of it."""
    rest = run[1:] if run[:1] == "\n" else run
    return not rest or rest[0] in SPACES or rest[-1] in SPACES


class Vocabulary:
    """A tokenizer file with its proved whole tokens and what has been seen so far."""

    def __init__(self, path: str | None):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tool = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.tool.no_truncation()
        self.tool.no_padding()
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        self._whole: frozenset[str] | None = None
        self.counts: tuple[dict, dict] = ({}, {})
        self.ids: tuple[dict, dict] = ({}, {})
        self.pre: dict[str, bytes] = {}
        self.bad: set[str] = set()

    @classmethod
    def of(cls, path: str | None) -> "Vocabulary":
        key = path or ""
        if key not in _LOADED:
            _LOADED[key] = cls(path)
        return _LOADED[key]

    @property
    def whole(self) -> frozenset[str]:
        """Strings of the vocabulary that are one pre-token and that encode alone as one token."""
        if self._whole is None:
            letters, found = byte_letters(), []
            for entry in self.tool.get_vocab():
                if entry in self.special or not all(c in letters for c in entry):
                    continue
                try:
                    text = bytes(letters[c] for c in entry).decode()
                except UnicodeDecodeError:
                    continue
                if self.pattern.findall(text) == [text]:
                    found.append(text)
            codes = self.tool.encode_batch_fast(found, add_special_tokens=False)
            self._whole = frozenset(t for t, c in zip(found, codes, strict=True) if len(c.ids) == 1)
        return self._whole

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [c.ids for c in self.tool.encode_batch_fast(texts, add_special_tokens=False)]

    def count_runs(self, runs: list[str]) -> list[int]:
        """Tokens of each run: whole tokens at once, merges for the other pre-tokens only."""
        whole, rest, out = self.whole, {}, []
        split = []
        for run in runs:
            pre = [run] if any(s in run for s in self.special) else self.pattern.findall(run)
            left = [p for p in pre if p not in whole]
            for p in left:
                rest[p] = 0
            split.append((len(pre) - len(left), left))
        for p, ids in zip(rest, self._encode(list(rest)), strict=True):
            rest[p] = len(ids)
        for known, left in split:
            out.append(known + sum(rest[p] for p in left))
        return out

    def id_runs(self, runs: list[str]) -> list[bytes]:
        """Ids of each run, through the merges for pre-tokens not met before."""
        if len(self.pre) > REMEMBER:
            self.pre.clear()
        pre = self.pre
        split = [[run] if "|" in run and any(s in run for s in self.special) else self.pattern.findall(run) for run in runs]
        new = list({p for s in split for p in s if p not in pre})
        pre.update(zip(new, self._bytes(self._encode(new)), strict=True))
        return [pre[s[0]] if len(s) == 1 else b"".join([pre[p] for p in s]) for s in split]

    def spaced_runs(self, runs: list[str]) -> list[bytes]:
        """Ids of each run, many encoded as one text. Every run begins with white space behind which something else stands,
        and ends with something else, so no pre-token goes from one to the next; where each id begins in the text tells
        the run it belongs to. If a run should be left without ids, the runs of its text are encoded alone."""
        if any(c in SPACES for s in self.special for c in s):
            return self.id_runs(runs)
        out: list[bytes] = []
        groups = [runs[lo:lo + GROUP] for lo in range(0, len(runs), GROUP)]
        for group, code in zip(groups, self.tool.encode_batch(["".join(g) for g in groups], add_special_tokens=False), strict=True):
            found = code.ids  # made anew each time it is asked for
            begins = list(accumulate(map(len, group), initial=0))
            cuts = np.searchsorted([a for a, _ in code.offsets], begins)
            if (cuts[1:] > cuts[:-1]).all() and cuts[0] == 0 and cuts[-1] == len(found):
                ids = np.array(found, "<u4").tobytes()
                out += [ids[a:b] for a, b in pairwise((4 * cuts).tolist())]
            else:
                out += self.id_runs(group)
        return out

    @staticmethod
    def _bytes(codes: list[list[int]]) -> list[bytes]:
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in codes]

    def per_text(self, texts: list[str], memo: tuple[dict, dict], learn, learn_spaced) -> Iterator[map]:
        """For each text the remembered values of its runs. ``memo``: of runs as they stand, of runs behind one space."""
        plain, spaced = memo
        if len(plain) + len(spaced) + len(self.bad) > REMEMBER:
            plain.clear()
            spaced.clear()
            self.bad.clear()
        cut, bad = [], self.bad
        for t in texts:
            first, *rest = t.replace("\n", " \n").split(" ")
            cut.append(((first,) if first else (), rest))
        # Differences with a dict or a set look the runs up without a step of Python for each.
        new = set().union(*[b for _, b in cut]).difference(spaced).difference(bad)
        bad |= (worse := {r for r in new if crowded(r)})
        new = list(new - worse)
        spaced.update(zip(new, learn_spaced([r if r[:1] == "\n" else " " + r for r in new]), strict=True))
        for k, (a, b) in enumerate(cut):
            if b and (a and a[0][-1] in SPACES or not bad.isdisjoint(b)):
                cut[k] = RUN.findall(texts[k]), ()
        new = [r for r in set(chain.from_iterable(a for a, _ in cut)) if r not in plain]
        plain.update(zip(new, learn(new), strict=True))
        for a, b in cut:
            yield chain(map(plain.__getitem__, a), map(spaced.__getitem__, b))

    def count(self, texts: list[str]) -> list[int]:
        return [sum(v) for v in self.per_text(texts, self.counts, self.count_runs, self.count_runs)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        return [b"".join(v) for v in self.per_text(texts, self.ids, self.id_runs, self.spaced_runs)]


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters together; one text at least."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 512) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row.

    Null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids stay as they are; other columns are not
    read. ``path``: a tokenizer file present on every executor; by default the public vocabulary's own place there.
    """
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [c for lo, hi in slices(texts) for c in vocabulary.count(texts[lo:hi])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    text = text_or_empty(text_col)
    rows = df.select(id_col, text.alias("_t"), F.octet_length(text).cast("long").alias("_b"))
    counted = rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
