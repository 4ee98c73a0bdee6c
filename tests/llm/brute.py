"""Plain Python versions of the operators, over lists of rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text):
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def targets(sizes, share=1.5, weights=(3, 1, 2), most=2):
    """Target of each source from the sizes by source, the null source last."""
    order = sorted((s for s in sizes if s is not None), key=str.encode) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    wanted, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        rest = wanted - sum(most * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def conversations(rows):
    """conv_id to (turns digest, loss text, turns) of (conv_id, turn, role, text) rows."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for conv, turns in by.items():
        turns = [(r.decode(), t.decode()) for *_, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def shingles(text, width):
    found = words((text or "").translate(LOWER))
    if not found:
        return set()
    if len(found) < width:
        return {tuple(found)}
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def components(rows, width, percent=80):
    """doc_id to (number of shingles, smallest doc_id reachable), of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, both in shared.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def line_key(line):
    return line.strip(WS).translate(LOWER)


def deduped_lines(rows):
    """doc_id to (lines, dropped, text), of (doc_id, text) rows with distinct ids."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 10:
                holders[line_key(line)].add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(line_key(x), ())) < 2 or min(holders[line_key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def statistics(text):
    text = text or ""
    found = words(text)
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    covered = {j for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def copies(rows):
    """(doc_id, keep_id, size, sha) rows, sorted, of (doc_id, text) rows."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), sha(text)) for i in ids]
    return sorted(out, key=repr)
