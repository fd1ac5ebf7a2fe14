"""Brute-force statements of the operators' rules, on plain Python rows."""

from __future__ import annotations

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingle_set(text):
    w = WORDS.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(5)], strict=False))


def jaccard_components(docs, threshold=75):
    """{doc_id: (set size, smallest doc_id reachable)} by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= threshold * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def repeated_lines(docs, edits, least, trim, within=lambda a, b, n: edit_distance(a, b) <= n):
    """{(doc_id, line, near)} to remove, by comparing each line with all before it."""
    first, seen = {}, []
    for i, t in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        for n, line in enumerate((t or "").split("\n")):
            line = line.strip(trim)
            if len(line) >= least:
                first.setdefault(line, (i, n))
                seen.append((i, n, line))
    forms = sorted(first, key=first.get)
    near = {f for k, f in enumerate(forms) if any(
        abs(len(f) - len(g)) <= edits and within(f, g, edits) for g in forms[:k])}
    return {(i, n, first[x] == (i, n)) for i, n, x in seen if first[x] != (i, n) or x in near}


def secret_bases(text):
    """The contract's base spans, straight from its patterns."""
    out = []
    for m in re.finditer(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])"
                         r"|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for kind, (name, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)), 1):
        out += [(m.start(), kind, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return [s for _, _, s in sorted(out)]


def plain_targets(values, tokens, power):
    """{category: power of its tokens}, from parallel lists."""
    sums = {}
    for v, n in zip(values, tokens, strict=True):
        sums[v] = sums.get(v, 0) + n
    return {v: n ** power for v, n in sums.items() if v is not None and n}


def n_words(text):
    return len(WORDS.findall(text or ""))


def plain_sample(docs, targets, other, budget):
    """The ids that proportional fitting samples, from (id, text, lang, source, topic) rows, in plain loops."""
    def cell(lang, source, topic):
        return tuple(v if v in t else other for v, t in zip((source, lang, topic), targets, strict=True))

    tokens = {}
    for _, text, *rest in docs:
        k = cell(*rest)
        tokens[k] = tokens.get(k, 0) + len(WORDS.findall(text))
    total = sum(tokens.values())
    weight = {k: n / total for k, n in tokens.items()}
    most = {k: w / budget for k, w in weight.items()}
    for _ in range(400):
        for d, t in enumerate(targets):
            have = {}
            for k, w in weight.items():
                have[k[d]] = have.get(k[d], 0) + w
            seen = {v for k in tokens for v in [k[d]] if tokens[k]}
            rest = sum(n for k, n in tokens.items() if k[d] == other) / total
            scale = sum(t[v] for v in seen if v != other)
            goal = {v: rest if v == other else t[v] / scale * (1 - rest) for v in seen}
            weight = {k: w * goal[k[d]] / have[k[d]] if have[k[d]] else 0 for k, w in weight.items()}
        weight = {k: min(w, most[k]) for k, w in weight.items()}
    norm = sum(weight.values())
    chance = {k: min(1.0, weight[k] / norm * budget * total / n) if n else 1.0 for k, n in tokens.items()}
    draw = {i: int(hashlib.md5(f"{i}:0".encode()).hexdigest()[:13], 16) / float(1 << 52) for i, *_ in docs}
    return {i for i, _, *rest in docs if draw[i] < chance[cell(*rest)]}
