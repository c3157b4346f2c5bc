"""License notices in whole texts, by patience alignment with templates.

A text and a template are word lists. Words that occur once in each are anchors; the longest increasing
subsequence of their places keeps those in a common order; between two anchors the same is done again
with the words that are unique there, after equal words at both ends are taken. Coverage is the share of
the template's words that are aligned.

A notice stands within twice its template's length. Where a text holds ``least`` of a template, it holds
one of any set of words that makes up more than 1 - least of the template, so windows around all places
of the template's rarest such words are aligned, and nothing is missed however often a notice repeats.
A text without enough of a template's words is passed over before that.

Licenses share most of their wording. So for each template the words are known that it does not share
with a like one of another license (its version, NC or ND, Lesser, its name), and these must be aligned,
all of them where they are few. What is found then competes for its words: of two notices that overlap, the
one with more aligned words stands, then the better covered, then the shorter one; a span has one license.

Nulls and empty texts: no words, no license. Very long texts are read whole, in time that grows with their
length and with the places of a template's rarest words. Repeated rows keep a row each. An empty table gives
no rows; other columns are ignored. The license reported first is the best covered one; between templates of
equal coverage the longer one, then the first name.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import id_and_text, table
from tessera.llm.license_texts import TEMPLATES

_WORD = re.compile(r"\w+(?:[.\-]\w+)*")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def increasing(places: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for k, p in enumerate(places):
        at = bisect_left(tops, p)
        before.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(p)
            piles.append(k)
        else:
            tops[at], piles[at] = p, k
    out = []
    k = piles[-1] if piles else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), ascending in both."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: k for k, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and in_b.get(w) == 1}
        anchors = [(place[w], k) for k, w in enumerate(b[b0:b1], b0) if w in place]
        kept = [anchors[k] for k in increasing([i for i, _ in anchors])]
        pairs += kept
        if kept:
            for (i0, j0), (i1, j1) in zip([(a0 - 1, b0 - 1), *kept], [*kept, (a1, b1)]):
                todo.append((i0 + 1, i1, j0 + 1, j1))
    return sorted(pairs)


class Template(NamedTuple):
    license: str
    words: tuple[str, ...]
    kinds: frozenset[str]
    #: For each like template of another license: the places of the words that tell this one apart.
    apart: tuple[frozenset[int], ...]

    def told_apart(self, places: set[int]) -> bool:
        """If the aligned places hold what tells the template apart: all of up to _FEW words, _MOST of more."""
        return all(len(a & places) >= (len(a) if len(a) <= _FEW else _MOST * len(a)) for a in self.apart)


_FEW, _MOST = 8, 0.8
#: Templates are alike if one covers this share of the other.
_ALIKE = 0.6


def prepared(texts: dict[str, tuple[str, ...]]) -> tuple[Template, ...]:
    """Templates with the words that tell each from those of other licenses."""
    split = [(name, tuple(words(t))) for name, some in sorted(texts.items()) for t in some]
    out = []
    for name, w in split:
        shared: dict[str, set[int]] = {}  # for each license with a like template: the places that its templates have too
        for other in {o for o, _ in split if o != name}:
            aligned = [{i for i, _ in align(list(w), list(v))} for o, v in split if o == other]
            if max(map(len, aligned)) >= _ALIKE * len(w):
                shared[other] = set().union(*aligned)
        apart = {frozenset(range(len(w))) - places for places in shared.values()} - {frozenset()}
        out.append(Template(name, w, frozenset(w), tuple(sorted(apart, key=sorted))))
    return tuple(out)


@lru_cache(maxsize=4)
def _default(more: str | None = None) -> tuple[Template, ...]:
    return prepared(TEMPLATES | (full_texts(more) if more else {}))


def full_texts(folder: str) -> dict[str, tuple[str, ...]]:
    """Full texts of licenses from a folder: a file each, named after the license, with or without .txt. Notices of
    TEMPLATES under the same name stay."""
    out = {}
    for path in sorted(Path(folder).iterdir()):
        if path.is_file():
            name = path.name.removesuffix(".txt")
            out[name] = (*TEMPLATES.get(name, ()), path.read_text(encoding="utf-8", errors="replace"))
    return out


class Hit(NamedTuple):
    license: str
    coverage: float
    first: int
    end: int
    size: int
    aligned: int


def _at(w: list[str], start: int, stop: int, t: Template, least: float) -> Hit | None:
    """The template in a window of the text's words, if it is covered and told apart there."""
    pairs = align(w[start:stop], list(t.words))
    size = len(t.words)
    if not pairs or len(pairs) < least * size - 1e-9 or not t.told_apart({j for _, j in pairs}):
        return None
    return Hit(t.license, len(pairs) / size, start + pairs[0][0], start + pairs[-1][0] + 1, size, len(pairs))


def standing(hits: Iterable[Hit]) -> list[Hit]:
    """The hits that stand when those over the same words compete: more aligned words first, then coverage."""
    out: list[Hit] = []
    starts: list[int] = []  # of those that stand; they overlap by less than half of the shorter one
    for h in sorted(set(hits), key=lambda h: (-h.aligned, -h.coverage, h.end - h.first, h.license, h.first)):
        k = bisect_left(starts, h.first)
        near = out[max(0, k - 3) : k + 3]
        if all(2 * (min(h.end, o.end) - max(h.first, o.first)) <= min(h.end - h.first, o.end - o.first) for o in near):
            starts.insert(k, h.first)
            out.insert(k, h)
    return out


def scan(w: list[str], least: float = 0.8, templates: tuple[Template, ...] | None = None) -> list[Hit]:
    """The license notices among a text's words, in order: each covered to at least ``least`` by one template."""
    if not w:
        return []
    templates = _default() if templates is None else templates
    there, places, hits = set(w), None, []
    for t in templates:
        size = len(t.words)
        common = t.kinds & there
        if len(common) < len(t.kinds):
            if sum(x in common for x in t.words) < least * size - 1e-9 or not t.told_apart({k for k, x in enumerate(t.words) if x in common}):
                continue
        if places is None:
            wanted = frozenset().union(*(x.kinds for x in templates))
            places = {}
            for k, x in enumerate(w):
                if x in wanted:
                    places.setdefault(x, []).append(k)
        # The rarest words whose template places make up more than 1 - least.
        probes, held = [], 0
        count = Counter(t.words)
        for x in sorted(t.kinds, key=lambda x: (len(places.get(x, ())), x)):
            probes.append(x)
            held += count[x]
            if held > (1 - least) * size + 1e-9:
                break
        slack = size // 2 + 1
        # A window around the notice bears words that were put in; one of its own length bears neighbours like it.
        starts = {p - o for x in probes for o, y in enumerate(t.words) if y == x for p in places.get(x, ())}
        windows = {(max(0, at - m), max(0, at + size + m)) for at in starts for m in (0, slack)}
        hits += [h for start, stop in sorted(windows) if (h := _at(w, start, stop, t, least))]
    return standing(hits)


_FOUND = "doc_id long, n_words long, license string, coverage double, first_word long, end_word long, n_licenses long, licenses string"


def scan_documents(docs: DataFrame, least: float = 0.8, folder: str | None = None) -> DataFrame:
    """For each row of docs (columns doc_id and text) the best covered license, the words it spans, and all
    licenses found, sorted and comma-joined. folder: full texts to look for too, a file a license (see full_texts)."""
    templates = _default(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [k.split()[0] for k in _FOUND.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = words(text)
                found = scan(w, least, templates)
                top = min(found, key=lambda h: (-h.coverage, -h.size, h.license, h.first))[:4] if found else (None,) * 4
                every = sorted({h.license for h in found})
                rows.append((doc_id, len(w), *top, len(every), ",".join(every)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(read, _FOUND)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses in all documents, covered to 80 % or more."""
    return scan_documents(table(spark, sf_dir, "documents"), 0.8)
