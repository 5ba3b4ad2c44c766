"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib

import regex

from creditflow.llm.decontamination import UNITS

WORD = r"[^\x20\x09-\x0D]+"
STRIP = " \t\n\x0b\x0c\r"
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(rows, least=10):
    key = lambda line: line.strip(STRIP).translate(LOW)
    found = collections.Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (key(x) and found[key(x)] >= least)]
        yield i, len(lines), len(lines) - len(keep), sha("\n".join(keep))


def substring_dedup(rows, k=50):
    first, texts = {}, collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(re.findall(WORD, t or ""))
    for i in sorted((x for x in texts if x is not None)):
        for words in texts[i]:
            for p in range(len(words) - k + 1):
                first.setdefault(tuple(words[p:p + k]), i)
    for i, several in texts.items():
        for words in several:
            gone = [False] * len(words)
            for p in range(len(words) - k + 1 if i is not None else 0):
                if first[tuple(words[p:p + k])] < i:
                    gone[p:p + k] = [True] * k
            yield i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone, strict=True) if not g))


def suffix_dedup(rows, width=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    found = collections.Counter(b[p:p + width] for _, b in texts for p in range(len(b) - width + 1))
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if found[b[p:p + width]] > 1:
                gone[p:p + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        yield i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()


def jaccard(rows, k=3, percent=90):
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, (t or "").translate(LOW))
        sets[i] = frozenset(tuple(w[p:p + k]) for p in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), find(i)) for i in ids]


def base_rules(text):
    text = text or ""
    w = re.findall(WORD, text)
    found = collections.Counter(tuple(w[p:p + 5]) for p in range(len(w) - 4))
    repeat = {q for p in range(len(w) - 4) if found[tuple(w[p:p + 5])] > 1 for q in range(p, p + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat)


def kneser_ney(counts: dict, alphabet: int = 64):
    """Probability function of an interpolated modified Kneser-Ney model from 4-gram counts (tuples)."""
    orders = {4: counts}
    for n in (3, 2, 1):
        left = collections.defaultdict(set)
        for g in orders[n + 1]:
            left[g[1:]].add(g[0])
        orders[n] = {g: len(s) for g, s in left.items()}
    cuts, totals, kinds = {}, {}, {}
    for n, table in orders.items():
        c = [sum(v == k for v in table.values()) for k in range(1, 5)]
        if c[0] and c[1]:
            y = c[0] / (c[0] + 2 * c[1])
            d = [1 - 2 * y * c[1] / c[0], 2 - 3 * y * c[2] / c[1], 3 - 4 * y * c[3] / c[2] if c[2] else 1.5]
            d = [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]
        else:
            d = [0.5] * 3
        cuts[n] = d
        totals[n], kinds[n] = collections.Counter(), collections.defaultdict(float)
        for g, v in table.items():
            totals[n][g[:-1]] += v
            kinds[n][g[:-1]] += d[min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / alphabet
        n = len(g)
        lower = p(g[1:])
        if not totals[n][g[:-1]]:
            return lower
        v = orders[n].get(g, 0)
        own = (v - cuts[n][min(v, 3) - 1]) / totals[n][g[:-1]] if v else 0
        return own + kinds[n][g[:-1]] / totals[n][g[:-1]] * lower

    return p


def merkle(rows, fan=16):
    """rows of doc_id, source, lang, n_chars, text."""
    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def tree(nodes):
        """Root, and each node's (left, right) siblings from below."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, path in enumerate(paths):
                lo = at[k] // fan * fan
                path.append(("".join(nodes[lo:at[k]]), "".join(nodes[at[k] + 1:lo + fan])))
                at[k] //= fan
            nodes = [sha("".join(nodes[i:i + fan])) for i in range(0, len(nodes), fan)]
        return nodes[0], paths

    leaves = collections.defaultdict(list)
    for row in rows:
        leaf = sha("".join(map(field, row)))
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
        seen = sha("".join(map(field, (*row[:4], row[4].translate(LOW))))) if hit else leaf
        leaves[row[1]].append(((row[0] is not None, row[0] or 0, leaf, seen), row[0]))
    sources = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([k[2] for k, _ in sorted(leaves[s], key=lambda x: x[0])]) for s in sources]
    root, upper = tree([t[0] for t in trees]) if sources else (None, [])
    for source, (subroot, paths), above in zip(sources, trees, upper, strict=True):
        for (key, doc_id), path in zip(sorted(leaves[source], key=lambda x: x[0]), paths, strict=True):
            folded = key[3]
            for left, right in path + above:
                folded = sha(left + folded + right)
            yield doc_id, source, key[2], subroot, root, sha("".join(a + b for a, b in path + above)), folded, folded == root


def template_marks(text):
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    text = regex.sub(r"[0-9]+(?:[.,:/][0-9]+)*", "\x01n", text or "")
    text = regex.sub(rf"(\x01n[ \t]?)(?i:{units})(?![\p{{L}}/])", "\\1\x01u", text)
    return re.findall(WORD, regex.sub(r"(?<![\p{L}\p{N}'’-])\p{Lu}[\p{L}'’-]*", "\x01p", text).lower())


def decontaminate(docs, items, width=5, percent=80):
    """(doc_id, item_id) -> n_windows, n_hits, at_word, same_values."""
    def windows(text):
        marks, words = template_marks(text), [w.lower() for w in re.findall(WORD, text or "")]
        keys = [(tuple(marks[i:i + width]), tuple(words[i:i + width])) for i in range(max(1, len(marks) - width + 1))] if marks else []
        return marks, words, [m if any(regex.search(r"^[^\x01]*\p{L}[^\x01]*$", x) for x in m) else ("values", w) for m, w in keys]

    out = {}
    cut = [(i, *windows(t)) for i, t in items]
    for doc, text in docs:
        _, own, keys = windows(text)
        where = collections.defaultdict(list)
        for at, k in enumerate(keys):
            where[k].append(at)
        for item, marks, words, wanted in cut:
            n, hits = len(wanted), collections.defaultdict(set)
            for i, k in enumerate(wanted):
                for at in where[k]:
                    hits[at - i].add(i)
            reach, regions = max(width, n // 3), collections.defaultdict(list)
            for at, hit in hits.items():
                for s in (at // reach, at // reach - 1):
                    regions[s].append((-len(hit), at, sorted(hit)))
            kept = [r for r in regions.values() if len(r) > 1] + [[(-len(h), at, sorted(h))] for at, h in hits.items()]
            best = None
            for parts in kept:
                spots = {}
                for _, at, hit in sorted(parts):
                    for i in hit:
                        spots.setdefault(i, at)
                if 100 * len(spots) < percent * n:
                    continue
                slots = [[(marks[j], words[j], own[j + at]) for j in range(i, min(i + width, len(words))) if "\x01" in marks[j]] for i, at in spots.items()]
                same = sum(all(a == b for _, a, b in w) for w in slots)
                pairs = {x for w in slots for x in w}
                clear = len({(m, a) for m, a, _ in pairs}) == len(pairs) == len({(m, b) for m, _, b in pairs})
                count = len(slots) if clear else same
                if 100 * count >= percent * n:
                    rank = (count, -min(parts)[1], same == count)
                    best = max(best, rank) if best else rank
            if best:
                out[doc, item] = (n, best[0], -best[1], best[2])
    return out


def quotations(rows, width=4, percent=80):
    """(conv_id, turn) -> reply_to, position, n_passages, n_linked, text; turns are distinct."""
    level = lambda x: re.match(r"^[ ]*(?:>[ ]?)*", x)[0].count(">")
    words = lambda xs: re.findall(WORD, " ".join(re.sub(r"^[ ]*(?:>[ ]?)+", "", x) for x in xs).lower())
    grams = lambda w, k: [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    out = {}
    for conv in {r[0] for r in rows}:
        cut = {turn: [(k, list(g)) for k, g in itertools.groupby(text.split("\n"), key=level)] for turn, text in sorted(r[1:3] for r in rows if r[0] == conv)}
        own = {}
        for turn, runs in cut.items():
            mine = words([x for k, run in runs if not k for x in run])
            own[turn] = {g for k in range(1, width + 1) for g in grams(mine, k)}
        replies, seen = [], []
        for turn, runs in cut.items():
            best = {}
            for at, (k, run) in enumerate(runs):
                w = words(run)
                asked = grams(w, width) if len(w) >= width else [tuple(w)] if w else []
                last = [(max((t for t in seen if g in own[t]), default=None), i, g) for i, g in enumerate(asked)]
                last = [x for x in last if x[0] is not None]
                if not k or not last:
                    continue
                votes = collections.Counter(t for t, _, _ in last)
                candidates = {max((n, t) for t, n in votes.items())[1], min((sum(g in own[m] for m in own), i, t) for t, i, g in last)[2]}
                n, owner = max((sum(g in own[t] for g in asked), t) for t in candidates)
                if 100 * n >= percent * len(asked):
                    best[k, at] = owner
            reply = best[min(best)] if best else seen[-1] if seen else None
            gone = {at for _, at in best}
            left = "\n".join(x for i, (_, run) in enumerate(runs) if i not in gone for x in run)
            out[conv, turn] = [reply, None, sum(k > 0 for k, _ in runs), len(best), left]
            replies.append((-1 if reply is None else reply, turn))
            seen.append(turn)
        for at, (_, turn) in enumerate(sorted(replies)):
            out[conv, turn][1] = at
    return {k: tuple(v) for k, v in out.items()}
