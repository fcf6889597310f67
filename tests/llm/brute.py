"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import math
import re
from collections import Counter

WORD = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")


def shingles(text, n=5):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard_links(sets):
    """Pairs of positions with a similarity of 0.8 or more."""
    out = set()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                common = len(a & b)
                if 5 * common >= 4 * (len(a) + len(b) - common):
                    out.add((j, i))
    return out


def classes(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def base_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, lines, dup = len(words), set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    seen = {}
    for i in range(n - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = n < 20 or 100 * len(repeated) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated), failed


def secret_spans(text, patterns, least):
    out = []
    for kind, (pattern, group) in enumerate(patterns):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[group]) >= least[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def backoff(texts, order, alpha):
    words = [WORD.findall((t or "").lower()) for t in texts]
    own = [Counter(tuple(w[k : k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1)) for w in words]
    total, n_all = Counter(), sum(map(len, words))
    for c in own:
        total.update(c)
    out = []
    for w, mine in zip(words, own):
        rest, score, backed = n_all - len(w), 0.0, 0
        for k in range(len(w)):
            penalty, done = 0.0, False
            for n in range(min(order, k + 1), 0, -1):
                g = tuple(w[k - n + 1 : k + 1])
                if (c := total[g] - mine[g]) > 0:
                    score += penalty + math.log(c / (total[g[:-1]] - mine[g[:-1]] if n > 1 else rest))
                    done = True
                    break
                penalty += math.log(alpha) if n > 1 else 0
            if not done:
                score += penalty - math.log(rest + 1)
            backed += not done or penalty < 0
        out.append((len(w), backed, score))
    return out


def near_sets(sets):
    """As ``jaccard_links``, by the pairs that share an element."""
    holders, common = {}, Counter()
    for k, s in enumerate(sets):
        for g in s:
            for j in holders.setdefault(g, []):
                common[j, k] += 1
            holders[g].append(k)
    return {(a, b) for (a, b), c in common.items() if 5 * c >= 4 * (len(sets[a]) + len(sets[b]) - c)}


def units(text):
    """Words as (lower case, start, end, line, sentence) of a text; lines end at a line feed, sentences at . ! or ? before a blank, and a
    sentence of fewer than five words that does not begin its line belongs to the one before."""
    found = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    pieces = []  # [line, words] of each piece between stops
    line = -1
    for k, (_, start, _) in enumerate(found):
        gap = text[found[k - 1][2] : start] if k else ""
        if not k or "\n" in gap:
            line += 1
            pieces.append([line, [k], True])
        elif set(gap) & set(".!?") and set(gap) & set(" \t\n\v\f\r"):
            pieces.append([line, [k], False])
        else:
            pieces[-1][1].append(k)
    sentences = []
    for line, words, leads in pieces:
        if len(words) < 5 and not leads:
            sentences[-1][1].extend(words)
        else:
            sentences.append((line, list(words)))
    out = [None] * len(found)
    for s, (line, words) in enumerate(sentences):
        for k in words:
            out[k] = (*found[k], line, s)
    return out


def _split(words, column):
    """The words of each unit, in order."""
    out = {}
    for k, w in enumerate(words):
        out.setdefault(w[column], []).append(k)
    return list(out.values())


def without_passages(texts, run=51, least=40):
    """Each text, in the order of the documents, without what earlier ones hold: (text, spans, words that went).

    Repeated are sentences word for word, lines of ten words or more in a cluster of lines with a similarity of 0.8, and runs of
    ``run`` equal words; stretches of ``least`` repeated words go."""
    words = [units(t or "") for t in texts]
    lines = []  # (document, places, distinct words of the line)
    for d, w in enumerate(words):
        for places in _split(w, 3):
            if len(places) >= 10:
                lines.append((d, places, tuple(w[k][0] for k in places)))
    kinds = sorted({t for *_, t in lines})
    label = dict(zip(kinds, classes(len(kinds), near_sets([{t[i : i + 5] for i in range(len(t) - 4)} for t in kinds]))))
    first_line, first_sentence, first_run = {}, {}, {}
    for d, _, t in lines:
        first_line.setdefault(label[t], d)
    out = []
    for d, (text, w) in enumerate(zip(texts, words)):
        hit = [False] * len(w)
        marked = [places for e, places, t in lines if e == d and first_line[label[t]] != d]
        for places in _split(w, 4):
            if first_sentence.setdefault(tuple(w[k][0] for k in places), d) != d:
                marked.append(places)
        for k in range(len(w) - run + 1):
            if first_run.setdefault(tuple(x[0] for x in w[k : k + run]), d) != d:
                marked.append(range(k, k + run))
        for places in marked:
            for k in places:
                hit[k] = True
        spans, gone, k = [], 0, 0
        while k < len(w):
            if not hit[k]:
                k += 1
                continue
            a = k
            while k < len(w) and hit[k]:
                k += 1
            if k - a < least:
                continue
            gone += k - a
            leads = a == 0 or w[a - 1][3] != w[a][3]  # nothing before it in its line
            begin = text.rfind("\n", 0, w[a][1]) + 1 if leads else w[a][1]
            end = text.find("\n", w[k - 1][2])
            end = len(text) if end < 0 else end
            if k < len(w) and w[k][1] < end:
                end = w[k][1]  # the rest of the line stays
            elif leads:
                end = min(end + 1, len(text))
            spans.append((begin, end))
        kept, at = [], 0
        for begin, end in spans:
            kept.append(text[at:begin])
            at = end
        out.append((text if not spans else "".join([*kept, text[at:]]), spans, gone))
    return out
