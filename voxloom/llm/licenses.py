"""Fuzzy search for short licence notices.

Every notice with up to k errors is cut into k + 1 pieces; by the pigeonhole principle one of them stands exactly
in any text that holds the notice with at most k errors. A plain substring search for these seeds locates windows,
and the regex library's bounded-error matching verifies each window and reports the span and error count of its best match. Words in braces name a version or a variant: they have to
stand there as they are, whole words, and errors count in the others only. Of spans that overlap, the one with the
least share of errors stays (then the longer one, then the one that starts first).

Words: A-Z lower-cased, then maximal runs of ASCII letters, digits and bytes from 0x80 up. Texts are searched as
their words joined by single spaces, so punctuation and line breaks inside a notice do not matter.
Null or empty texts have no words, no labels and score 0. Repeated rows are scanned one by one. Work and memory grow in
proportion to a text's length and its number of seeds.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Phrases whose exact places are counted, with their labels (fixed values of the contract).
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Notices searched with errors: (words, label, most errors). Words in braces allow none.
NOTICES = (
    ("released under the {mit} license", "mit", 2),
    ("licensed under the apache license version {2} 0", "apache-2", 3),
    ("licensed under {cc by nc} 4 0", "cc-by-nc", 1),
    ("licensed under the gnu general public license version {3}", "gpl-3", 4),
    ("licensed under the gnu lesser general public license", "lgpl", 3),
    ("licensed under the gnu affero general public license", "agpl", 3),
    ("subject to the terms of the mozilla public license", "mpl", 3),
    ("redistribution and use in source and binary forms", "bsd", 3),
    ("licensed under {cc by sa} 4 0", "cc-by-sa", 1),
    ("all rights reserved no part of this", "all-rights-reserved", 2),
)

WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def seeds(notice: bytes, errors: int) -> list[tuple[int, bytes]]:
    """errors + 1 pieces of near-equal length, each with its offset."""
    n, parts = len(notice), errors + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Compiled notices; scan(text) gives the base places and the fuzzy spans of one text."""

    def __init__(self, notices=NOTICES, base=BASE):
        self.base = [(b" " + p.encode() + b" ", label) for p, label in base]
        self.notices = []
        for words, label, errors in notices:
            raw = words.replace("{", "").replace("}", "").encode()
            parts = []
            for i, part in enumerate(regex.split(r"[{}]", words)):  # every second part is exact
                if part:
                    part = regex.escape(part, special_only=True)
                    parts.append(rf"(?<= ){part}(?= )" if i % 2 else f"(?:{part}){{e<={errors}}}")
            self.notices.append((raw, label, errors, seeds(raw, errors), regex.compile(("(?b)" + "".join(parts)).encode())))

    def scan(self, text: bytes | None):
        """(number of words, base places, base labels, spans); a span is (label, start byte, end byte, errors, length of the notice) in the joined words."""
        words = (text or b"").lower().translate(WORD_BYTES).split()
        line = b" " + b" ".join(words) + b" "
        places, labels, spans = [], set(), []
        for phrase, label in self.base:
            at, seen, before = line.find(phrase), 0, 0
            while at >= 0:
                before += line.count(b" ", seen, at)
                seen = at
                places.append(before)
                labels.add(label)
                at = line.find(phrase, at + 1)
        for raw, label, errors, pieces, pattern in self.notices:
            windows = set()  # each as long as one notice with errors can be, so that none holds two of them
            for offset, seed in pieces:
                at = line.find(seed)
                while at >= 0:
                    windows.add((max(0, at - offset - errors - 1), at - offset + len(raw) + errors + 1))
                    at = line.find(seed, at + 1)
            for a, b in windows:
                if (m := pattern.search(line, a, b)) and sum(m.fuzzy_counts) <= errors:
                    spans.append((label, m.start(), m.end(), sum(m.fuzzy_counts), len(raw)))
        best, ends = [], []
        for s in sorted(spans, key=lambda s: (s[3] / s[4], s[1] - s[2], s[1], s[0])):
            i = bisect_left(ends, (s[1] + 1,))  # the first kept span that ends behind the start of this one
            if i == len(ends) or ends[i][1] >= s[2]:
                ends.insert(i, (s[2], s[1]))
                best.append(s)
        return len(words), places, labels, sorted(best, key=lambda s: s[1])


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES, base=BASE) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    labels: base labels and those of fuzzy spans, distinct, sorted, comma-joined ('' if none). score: 1 for a base
    phrase, else the best span's share of characters without error, 0 without spans. spans: array of
    (label, start, end, errors) over the joined words. A null id stays null; other columns are not read.
    """
    held = []
    kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int32())]))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Scanner(notices, base))
        out = [[] for _ in range(8)]
        for text in common.utf8(batch.column(1)):
            n, places, labels, spans = held[0].scan(text)
            score = 1.0 if places else max((1 - s[3] / s[4] for s in spans), default=0.0)
            row = (n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {s[0] for s in spans})), score, [dict(zip(("label", "start", "end", "errors"), s[:4])) for s in spans])
            for column, value in zip(out, row):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kind)
        names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names)

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return common.map_batches(src, kernel, "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:bigint,end:bigint,errors:int>>").withColumnRenamed("id", id_col)
