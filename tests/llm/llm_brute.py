"""Plain Python versions of the training-data operators, for small fixtures."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    text = text or ""
    ws = words(text)
    at = defaultdict(list)
    for i in range(len(ws) - 4):
        at[tuple(ws[i:i + 5])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    m = {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
         "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
         "line_chars": sum(map(len, lines)), "dup_line_chars": sum(map(len, lines)) - sum(map(len, set(lines))),
         "n_stutter": sum(a == b for a, b in zip(ws, ws[1:])), "n_repeat_words": len(covered)}
    m["base_failed"] = m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]
    m["kept"] = not (m["base_failed"] or 10 * m["n_symbols"] > m["n_words"] or m["word_chars"] < 2 * m["n_words"]
                     or m["word_chars"] > 14 * m["n_words"] or 10 * m["dup_line_chars"] > 3 * m["line_chars"]
                     or 100 * m["n_stutter"] > 30 * m["n_words"])
    return m


def repeats(texts, window):
    """(words, removed, kept text) of each text."""
    docs = [words(t) for t in texts]
    seen = Counter(tuple(d[i:i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = {i + k for i in range(len(d) - window + 1) if seen[tuple(d[i:i + window])] > 1 for k in range(window)}
        out.append((len(d), len(gone), " ".join(w for i, w in enumerate(d) if i not in gone)))
    return out


def shingles(text):
    ws = words(text)
    if len(ws) < 5:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}


def near(rows, threshold=0.8):
    """doc_id -> (class, class size, links), for rows (doc_id, text) with distinct ids."""
    sets = [(k, t or "", shingles(t)) for k, t in rows]
    links, up = Counter(), {k: k for k, _, _ in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for i, (a, ta, sa) in enumerate(sets):
        for b, tb, sb in sets[i + 1:]:
            if ta == tb or (sa and sb and len(sa & sb) >= threshold * len(sa | sb)):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                up[y] = x
    size = Counter(root(k) for k in up)
    return {k: (root(k), size[root(k)], links[k]) for k in up}


def dropped_lines(texts, min_texts, min_tokens, depth=3):
    """Numbers of the lines to drop of each text, by the template rule.

    A token is a fixed word if at least the line's bar of distinct texts agree on it
    in its leaf and place; the bar is ``min_texts``, doubled while half of the
    line's tokens still reach it.  A template goes if enough distinct texts have it.
    """
    found = []
    for k, t in enumerate(texts):
        for i, line in enumerate((t or "").split("\n")):
            if len(line.split()) >= min_tokens:
                m = tuple("<*>" if re.search(r"\d", x) else x for x in line.split())
                found.append((k, i, (len(m), m[:depth]), m))
    support = defaultdict(set)
    for k, _, leaf, m in found:
        for p, tok in enumerate(m):
            support[leaf, p, tok].add(texts[k])

    def template(leaf, m):
        n = [0 if tok == "<*>" else len(support[leaf, p, tok]) for p, tok in enumerate(m)]
        bar = None
        for j in range(40):
            if 2 * sum(x >= min_texts << j for x in n) >= len(m):
                bar = min_texts << j
        return bar and tuple(tok if x >= bar else "<*>" for x, tok in zip(n, m))
    carriers = defaultdict(set)
    for k, _, leaf, m in found:
        carriers[leaf, template(leaf, m)].add(texts[k])
    out = [set() for _ in texts]
    for k, i, leaf, m in found:
        t = template(leaf, m)
        if t and len(carriers[leaf, t]) >= min_texts:
            out[k].add(i)
    return out
