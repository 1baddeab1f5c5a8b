"""Plain, slow versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from stallkeeper.llm import secrets, url_filters

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def line_dedup(rows, min_chars=10):
    """(text, n_lines, n_dropped) of each (id, text)."""
    key = lambda line: line.translate(LOWER).strip(" \t\n\x0b\x0c\r")
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def contamination(rows, items, window=13):
    """(n_words, n_hit, items) of each text."""
    windows = defaultdict(set)
    for name, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if name is not None and w else 0):
            windows[tuple(w[i : i + size])].add(str(name))
    out = []
    for text in rows:
        w, hit, names = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= found
        out.append((len(w), len(hit), names))
    return out


def near_duplicates(rows):
    """{id: (class id, links)} of (id, text) with distinct ids."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset())
    holding, links, parent = defaultdict(list), [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holding[x])
        if not s:
            common = dict.fromkeys((j for j in range(i) if not sets[j]), 0)
        for j, n in common.items():
            if not s or 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            holding[x].append(i)
    classes = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        classes[root(i)].append(doc)
    return {doc: (min(classes[root(i)]), links[i]) for i, (doc, _) in enumerate(rows)}


def secret_spans(text):
    """Spans of the known forms as (start, kind, end)."""
    out = []
    for kind, (_, pattern, group, least) in enumerate(secrets.FORMS):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m.group(2) if group == 4 else m.group()) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def url_verdicts(urls, rules, labels=None):
    """(host, path, rule, verdict, purity, template) of each url, by walking the tree of each host."""
    rows = []
    for i, url in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
        fits = []
        for rule in rules:
            name, slash, rest = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
                fits.append(rule)
        rule = max(fits, key=len, default=None)
        bad = None
        if rule:
            bad = float(rules[rule] == "block")
        elif labels and labels[i] is not None:
            bad = float(labels[i])
        elif set(re.split(r"[.\-]", host)) & set(url_filters.BAD_WORDS):
            bad = 1.0
        parts = tuple(re.sub(r"\d+", "{n}", re.sub(r"(?=[0-9a-f]*[0-9])[0-9a-f]{8,}", "{x}", p)) for p in path.split("/") if p)
        rows.append([host, path, rule, bad, parts])

    purity, template = {}, {}

    def weights(group):
        labelled = sum(rows[i][3] is not None for i in group)
        return sum(rows[i][3] or 0.0 for i in group), labelled + url_filters.UNLABELLED * (len(group) - labelled)

    def bin_of(group):
        bad, weight = weights(group)
        return sum(border <= bad / weight for border in url_filters.bin_borders())

    def walk(group, level, share, name):
        below = defaultdict(list)
        for i in group:
            purity[i], template[i] = share, name
            if len(rows[i][4]) > level:
                below[rows[i][4][level]].append(i)
        bins = defaultdict(list)
        for part in below:
            bins[bin_of(below[part])].append(part)
        branches = []
        for _, parts in sorted(bins.items()):
            now = weights([i for p in parts for i in below[p]])
            if branches:
                last = weights([i for p in branches[-1] for i in below[p]])
                pooled = (now[0] + last[0]) / (now[1] + last[1])
                spread = (pooled * (1 - pooled) * (1 / now[1] + 1 / last[1])) ** 0.5
                apart = abs(now[0] / now[1] - last[0] / last[1])
            if not branches or (apart > 0 and apart >= url_filters.SIMILAR * spread):
                branches.append([])
            branches[-1] += parts
        # Where children are one branch nothing differs here, but further down something may.
        shapes = defaultdict(list)
        for own in below.values():
            for i in own:
                shapes[rows[i][4]].append(i)
        shares = {weights(own)[0] / weights(own)[1] for own in shapes.values()}
        if len(shares) < 2 or sum(weights(own)[1] for own in below.values()) < url_filters.SIMILAR**2:
            return
        for number, parts in enumerate(branches):
            own = [i for p in parts for i in below[p]]
            bad, weight = weights(own)
            node = (bad + url_filters.PRIOR * share) / (weight + url_filters.PRIOR) if len(branches) > 1 else share
            label = parts[0] if len(parts) == 1 else "/*" if len(branches) == 1 else f"/*{number}"
            walk(own, level + 1, node, f"{name}/{label}")

    hosts = defaultdict(list)
    for i, row in enumerate(rows):
        hosts[row[0]].append(i)
    for group in hosts.values():
        bad, weight = weights(group)
        walk(group, 0, (bad + url_filters.PRIOR * url_filters.ROOT) / (weight + url_filters.PRIOR), "")
    out = []
    for i, (host, path, rule, _, _) in enumerate(rows):
        verdict = rules[rule] if rule else "block" if purity[i] >= url_filters.REJECT else "allow"
        out.append((host, path, rule, verdict, purity[i], template[i]))
    return out
