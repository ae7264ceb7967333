"""Licence notices in texts by patience alignment.

Where two neighbouring words of a template occur in a text, they vote for the place where the template
would begin. Around places with enough votes the text is aligned with the template: words that are
unique in both are anchors, the longest increasing subsequence of anchors is kept, and the gaps between
them are aligned in the same way; equal words at a gap's ends match directly. Alignments of narrow and
wide regions around one place compete by words matched less words skipped, and each is cut to the part
worth most, so it ends where it would jump to another copy. The share of template words matched is the
coverage. The best match of a text is settled first and takes its words; others get what is left, so
copies and shortened copies that touch are told apart.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import Words, separator_table, sliced, window_hashes
from estrato.llm.license_texts import COMMON, TEMPLATES, VARIANTS

COVERAGE = 0.8
SHORT = 20
"""Templates of fewer words must match in every word but the COMMON ones."""
REPEATS = 4
"""Pairs of words that a template has more often don't vote."""
DENSITY = 0.5
"""Least share of matched words in the stretch of text that a match takes up."""
SEPARATORS = separator_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

FIELDS = {"licenses": "array<string>", "coverages": "array<double>", "spans": "array<int>"}


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places (i, j) of two word sequences, ascending in both."""
    found = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, n = todo.pop()
        while i < k and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < n and a[k - 1] == b[n - 1]:
            k, n = k - 1, n - 1
            found.append((k, n))
        if i >= k or j >= n:
            continue
        once_a, once_b = _unique(a, i, k), _unique(b, j, n)
        anchors = sorted((p, once_b[w]) for w, p in once_a.items() if w in once_b)
        chain = [anchors[x] for x in increasing([q for _, q in anchors])]
        if not chain:
            continue
        found += chain
        ends = [(i - 1, j - 1), *chain, (k, n)]
        todo += [(p + 1, x, q + 1, y) for (p, q), (x, y) in zip(ends, ends[1:])]
    return sorted(found)


def worth(found: list[tuple[int, int]]) -> int:
    """Two for each matched word, less one for each word skipped between them."""
    return 3 * len(found) - (found[-1][0] - found[0][0] + 1) if found else 0


def tightened(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The part of a match that is worth most: words beyond a gap stay if they are over half as many as it skips."""
    best, first, held = (0, 0, 0), 0, 0
    for k, (i, _) in enumerate(found):
        if k:
            held -= i - found[k - 1][0] - 1
        if held <= 0:
            first, held = k, 0
        held += 2
        if held > best[0]:
            best = held, first, k + 1
    return found[best[1] : best[2]]


def match_at(text: list[int], own: list[int], begin: int, least: int, most: int) -> list[tuple[int, int]]:
    """The best alignment of a template that would begin at `begin`, within text[least:most]."""
    best: list[tuple[int, int]] = []
    for slack in (0, 4, len(own) // 8, len(own) // 2 + 1):
        lo, hi = max(least, begin - slack), min(most, begin + len(own) + slack)
        if lo < hi:
            found = tightened([(lo + i, j) for i, j in aligned(text[lo:hi], own)])
            best = found if worth(found) > worth(best) else best
        if worth(best) == 2 * len(own):
            break
    return best


def _unique(words: list[int], start: int, end: int) -> dict[int, int]:
    seen: dict[int, int] = {}
    for p in range(start, end):
        seen[words[p]] = -1 if words[p] in seen else p
    return {w: p for w, p in seen.items() if p >= 0}


class Scanner:
    """Templates as word hashes, and the pairs of neighbouring words that point to them."""

    def __init__(self, templates: dict[str, str]):
        words = Words([t.encode().translate(_LOWER) for t in templates.values()], SEPARATORS)
        hashes = words.hashes()
        self.names = list(templates)
        self.words = [hashes[words.first[k] : words.first[k + 1]].tolist() for k in range(len(self.names))]
        votes = []  # (pair, template, place in it) of pairs that a template has a few times at most
        for t, own in enumerate(self.words):
            pairs = window_hashes(np.array(own, np.uint64), min(2, len(own))) if own else np.zeros(0, np.uint64)
            _, which, n = np.unique(pairs, return_inverse=True, return_counts=True)
            votes += [(pair, t, j) for j, (pair, k) in enumerate(zip(pairs.tolist(), which.tolist())) if n[k] <= REPEATS]
        votes.sort()
        self.pairs, self.first = np.unique(np.array([v[0] for v in votes], np.uint64), return_index=True)
        self.first = np.append(self.first, len(votes))
        self.template, self.place = np.array([v[1] for v in votes], np.int64), np.array([v[2] for v in votes], np.int64)
        self.votes = np.bincount(self.template, minlength=len(self.names))

        few = Words([w.encode() for w in (COMMON, VARIANTS, "version v", " ".join(map(str, range(100))))], SEPARATORS)
        known = few.hashes().tolist()
        common, self.variants, version, self.numbers = (set(known[a:b]) for a, b in zip(few.first, few.first[1:]))
        self.needed = []
        zero = known[few.first[3]]  # version 2 is version 2.0
        for own in self.words:
            digits = {j for j, w in enumerate(own) if w in self.numbers and w != zero and any(x in version for x in own[max(0, j - 2) : j]) and all(x in version or x in self.numbers for x in own[max(0, j - 1) : j])}
            self.needed.append({j for j, w in enumerate(own) if w not in common and w != zero} if len(own) < SHORT else digits)

    def contradicted(self, text: list[int], t: int, found: list[tuple[int, int]]) -> bool:
        """Whether the text names another licence or version than a template that it matches."""
        missing = self.needed[t] - {j for _, j in found}
        if missing and len(self.words[t]) < SHORT:
            return True
        for (i, j), (k, n) in zip(found, found[1:]):
            gap = text[i + 1 : k]
            if gap and gap[-1] in self.variants or any(x in missing for x in range(j + 1, n)) and (not gap or any(w in self.numbers for w in gap)):
                return True
        return False

    def begins(self, t: int, offsets: np.ndarray) -> list[int]:
        """Places worth aligning template t at: by votes (a rising array of places, repeats included)."""
        need, width = max(1, (2 * int(self.votes[t])) // 5), len(self.words[t]) * 4 // 5 + 1
        if len(offsets) < need:
            return []
        place, n = np.unique(offsets, return_counts=True)
        total = np.concatenate(([0], np.cumsum(n)))
        end = np.searchsorted(place, place + width)
        enough = np.flatnonzero(total[end] - total[:-1] >= need)
        found, last = set(), None
        for k in enough.tolist():
            found.update(place[k : end[k]][n[k : end[k]] >= max(3, len(self.words[t]) // 10)].tolist())
            if last is None or last < place[k]:
                last = int(place[k + int(np.argmax(n[k : end[k]]))])
                found.add(last)
        return sorted(found)

    def matches(self, text: list[int], t: int, begins: list[int], coverage: float, density: float) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, first word, end word, score) of template t at some of the places it may begin at; no word is used twice."""
        own = self.words[t]

        def good(found: list[tuple[int, int]]) -> bool:
            return len(found) >= coverage * len(own) and len(found) >= density * (found[-1][0] - found[0][0] + 1)

        found = [(b, match) for b in begins for match in [match_at(text, own, b, 0, len(text))] if match and good(match)]
        found.sort(key=lambda x: (-worth(x[1]), -len(x[1]), x[1][0][0], x[0]))
        taken: list[tuple[int, int]] = []
        out = []
        for begin, match in found:
            middle = match[len(match) // 2][0]
            if any(a <= middle < b for a, b in taken):
                continue
            least, most = max([0, *(b for _, b in taken if b <= middle)]), min([len(text), *(a for a, _ in taken if a > middle)])
            if match[0][0] < least or match[-1][0] >= most:
                match = match_at(text, own, begin, least, most)
                if not match or not good(match):
                    continue
            if not self.contradicted(text, t, match):
                first, end = match[0][0], match[-1][0] + 1
                taken.append((first, end))
                out.append((self.names[t], len(match) / len(own), first, end, worth(match) - len(own)))
        return out

    def scan(self, text: list[int], places: np.ndarray, known: np.ndarray, coverage: float, density: float = DENSITY) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, end word) of the best matches; places are where known pairs begin, `known` their numbers."""
        size = self.first[known + 1] - self.first[known]
        vote = np.repeat(self.first[known] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        template, begin = self.template[vote], np.repeat(places, size) - self.place[vote]
        order = np.lexsort((begin, template))
        template, begin = template[order], begin[order]
        bounds = np.searchsorted(template, np.arange(len(self.names) + 1))
        found = []
        for t in np.flatnonzero(np.diff(bounds) * 5 >= 2 * self.votes).tolist():
            found += self.matches(text, t, self.begins(t, begin[bounds[t] : bounds[t + 1]]), coverage, density)
        return sorted(winners(found), key=lambda x: (x[2], -x[3], x[0]))


def winners(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int]]:
    """Of matches that share over half of the shorter one's span the best aligned: matched words less those left over on both sides."""
    kept: list[tuple[str, float, int, int]] = []
    for name, share, first, end, _ in sorted(found, key=lambda x: (-x[4], x[0])):
        if all(2 * (min(end, e) - max(first, f)) <= min(end - first, e - f) for _, _, f, e in kept):
            kept.append((name, share, first, end))
    return kept


def with_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """`docs` (any columns, text among them) with licenses, coverages and spans of all matches, by place.

    spans holds first and end word of each match; words are a-z, digits and non-ASCII characters after
    lower-casing A-Z. NULL, empty texts and texts without a match have empty arrays, as has an empty set of
    templates. Repeated rows and equal texts have equal results, a very long text is scanned whole, and an
    empty table stays empty. Of equally good matches over one span the template of the smaller name stands.
    Templates are a small dictionary that goes to every task. Added columns replace columns of the same names.
    """
    docs = docs.drop(*FIELDS)
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(TEMPLATES if templates is None else templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = scanner.value
        for batch in batches:
            found: list[list[tuple[str, float, int, int]]] = []
            for lo, hi, texts in sliced(batch.column("text")):
                words = Words([x.translate(_LOWER) for x in texts], SEPARATORS)
                hashes = words.hashes()
                pairs = np.append(window_hashes(hashes, 2), np.uint64(0)) if len(hashes) else hashes
                if len(pairs):
                    pairs[words.first[1:][words.first[1:] > words.first[:-1]] - 1] = 0  # no pair across texts
                at = np.minimum(np.searchsorted(known.pairs, pairs), max(0, len(known.pairs) - 1)) if len(known.pairs) else np.zeros(0, np.int64)
                hit = np.flatnonzero(known.pairs[at] == pairs) if len(known.pairs) else np.zeros(0, np.int64)
                bound = np.searchsorted(hit, words.first)
                for k in range(hi - lo):
                    mine = hit[bound[k] : bound[k + 1]]
                    first, last = words.first[k], words.first[k + 1]
                    found.append(known.scan(hashes[first:last].tolist(), mine - first, at[mine], coverage) if len(mine) else [])
            more = [pa.array([[m[0] for m in x] for x in found], pa.list_(pa.string())), pa.array([[m[1] for m in x] for x in found], pa.list_(pa.float64())),
                    pa.array([[p for m in x for p in m[2:]] for x in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *FIELDS])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} {t}" for n, t in FIELDS.items()]
    return docs.mapInArrow(run, ", ".join(fields))
