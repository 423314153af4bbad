"""Plain versions of the training-data operators: slow, row by row, without Spark and without the library's code."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- toxicity: two character Kneser-Ney models


def toxic_differences(labelled, texts, order=6, share=0.03):
    """labelled: (text, 0 or 1). The mean over a text's words of log((1 - share) + share * P1/P0)."""
    words = [Counter(w for text, y in labelled if y == c for w in re.findall(r"\w+", (text or "").lower())) for c in (0, 1)]
    models = []
    for c in (0, 1):
        levels = [None, *[Counter() for _ in range(order)]]
        for word, n in words[c].items():
            s = "\x02" + word + "\x03"
            for j in range(1, len(s)):
                gram = s[max(0, j - order + 1) : j + 1]
                levels[len(gram)][gram] += n
        for o in range(order, 1, -1):
            for gram in list(levels[o]):
                levels[o - 1][gram[1:]] += 1
        models.append(levels)
    pooled = models[0][1] + models[1][1]
    base = sum(pooled.values()) + len(pooled) + 1

    def cuts(level):
        have = Counter(level.values())
        y = have[1] / (have[1] + 2 * have[2]) if have[1] else 0.5
        return [0.0] + [min(max(k - (k + 1) * y * have[k + 1] / have[k] if have[k] else y, 0.05), k) for k in (1, 2, 3)]

    discount = [[None, *[cuts(level) for level in levels[1:]]] for levels in models]
    total = [[None, *[Counter() for _ in range(order)]] for _ in (0, 1)]
    taken = [[None, *[Counter() for _ in range(order)]] for _ in (0, 1)]
    for c in (0, 1):
        for o in range(1, order + 1):
            for gram, n in models[c][o].items():
                total[c][o][gram[:-1]] += n
                taken[c][o][gram[:-1]] += discount[c][o][min(n, 3)]

    def probability(c, gram):
        p = (pooled[gram[-1]] + 1) / base
        for o in range(1, len(gram) + 1):
            part = gram[len(gram) - o :]
            k = total[c][o][part[:-1]]
            if k:
                n = models[c][o][part]
                p = (n - discount[c][o][min(n, 3)]) / k + taken[c][o][part[:-1]] / k * p
        return p

    def difference(word):
        s = "\x02" + word + "\x03"
        return sum(math.log(probability(1, g) / probability(0, g)) for g in (s[max(0, j - order + 1) : j + 1] for j in range(1, len(s))))

    out = []
    for text in texts:
        found = re.findall(r"\w+", (text or "").lower())
        out.append(sum(math.log(1 - share + share * math.exp(difference(w))) for w in found) / len(found) if found else 0.0)
    return out


# --- secrets


def secret_spans(rows, base, added, max_owners=2, max_repositories=20):
    """rows: (row, text, owner, repository); base and added: {kind: pattern}. {row: [(start, kind, end, owners, repositories, live)]}."""
    kinds, found = [*base, *added], {}
    for row, text, owner, repository in rows:
        hits = []
        for kind, pattern in {**base, **added}.items():
            for m in re.finditer(pattern, text or ""):
                value = m[2] if kind == "assign" else m[0]
                if kind in base and len(value) < {"assign": 8, "access": 16, "hex": 32}[kind]:
                    continue
                if kind == "owned" and not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)):
                    continue
                hits.append((m.start(), kinds.index(kind), m.end(), kind, value))
        found[row] = sorted(hits), owner, repository
    owners, repositories = defaultdict(set), defaultdict(set)
    for hits, owner, repository in found.values():
        for *_, value in hits:
            owners[value].add(owner)
            repositories[value].add(repository)
    out = {}
    for row, (hits, _, _) in found.items():
        out[row], last = [], 0
        for start, _, end, kind, value in hits:
            counts = len(owners[value]), len(repositories[value])
            live = counts[0] <= max_owners and counts[1] <= max_repositories
            if kind not in base:
                if not live or start < last or any(h[3] in base and h[0] < end and start < h[2] for h in hits):
                    continue
                last = end
            out[row].append((start, kind, end, *counts, live))
    return out


# --- quality


def quality(docs, common, classes, min_words=50, max_chars=0.30, max_common=0.20, slack=1.0):
    """docs: (text, lang). (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of each."""
    vocabulary = {w for words in common.values() for w in words}

    def class_of(char):
        return next((name for name, chars in classes.items() if char in chars), "wide" if ord(char) >= 128 else "other")

    rows = []
    for text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        base = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
        chars = Counter(class_of(c) for c in text)
        seen = Counter(w if (w := re.sub("[A-Z]", lambda m: m[0].lower(), x)) in vocabulary else None for x in words)
        rows.append((base, len(words) < 10 or 100 * len(repeated) > 20 * len(words), chars, seen, lang))
    reference = defaultdict(lambda: (Counter(), Counter()))
    for base, failed, chars, seen, lang in rows:
        if not failed and base[0] >= min_words and lang in common:
            reference[lang][0].update(chars)
            reference[lang][1].update(seen)

    def distance(a, b):
        na, nb = sum(a.values()), sum(b.values())
        if not na or not nb:
            return None
        out = 0.0
        for k in set(a) | set(b):
            p, q = a[k] / na, b[k] / nb
            out += sum(x * math.log2(2 * x / (p + q)) for x in (p, q) if x)
        return math.sqrt(max(out / 2, 0.0))

    out = []
    for base, failed, chars, seen, lang in rows:
        kept = not failed
        if kept and base[0] >= min_words and lang in common:
            d = distance(chars, reference[lang][0]), distance(seen, reference[lang][1])
            kept = not (d[0] is not None and d[0] > max_chars) and not (d[1] is not None and d[1] > max_common + slack / math.sqrt(base[0]))
        out.append((*base, failed, kept))
    return out


# --- the other stages


def without_shared_lines(docs, least=8):
    """docs: (doc_id, text, site). Texts without the lines that `least` sites have, except at their first place."""
    blanks = " \t\n\x0b\f\r"
    sites, first = defaultdict(set), {}
    for doc_id, text, site in docs:
        for pos, line in enumerate((text or "").split("\n")):
            if line := line.strip(blanks):
                sites[line].add(site)
                first[line] = min(first.get(line, (doc_id, pos)), (doc_id, pos))
    out = []
    for doc_id, text, _ in docs:
        if text is not None:
            text = "\n".join(x for pos, x in enumerate(text.split("\n")) if not (y := x.strip(blanks)) or len(sites[y]) < least or first[y] == (doc_id, pos))
        out.append(text)
    return out


def components(docs, width, p):
    """docs: (doc_id, text). The least doc_id that each reaches by links of p percent of the union or more, by comparing all pairs."""
    sets = []
    for _, text in docs:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set())
    root = list(range(len(docs)))
    for a, b in combinations(range(len(docs)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= p * (len(sets[a]) + len(sets[b]) - common) and root[a] != root[b]:
            x, y = root[a], root[b]
            root = [x if r == y else r for r in root]
    least = {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, docs[i][0]), docs[i][0])
    return [least[r] for r in root], [len(s) for s in sets]


def mix(docs, seed=7, weights=(5, 2, 1), cap=3):
    """docs: (doc_id, text, source). How often each is emitted."""
    sizes = [len(WORD.findall(text or "")) for _, text, _ in docs]
    own = Counter()
    for (_, _, source), n in zip(docs, sizes, strict=True):
        own[source] += n
    ranked = sorted(own, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ranked)}
    target, left, free = {}, Fraction(sum(sizes)), set(ranked)
    while free:
        per = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * per >= cap * own[s]}
        if not full:
            target |= {s: weight[s] * per for s in free}
            break
        target |= {s: Fraction(cap * own[s]) for s in full}
        left, free = left - sum(cap * own[s] for s in full), free - full
    out = [0] * len(docs)
    for source in ranked:
        rows = []
        for i, (doc_id, _, s) in enumerate(docs):
            if s == source:
                n = sizes[i]
                digest = hashlib.md5(f"{seed}:{doc_id}".encode()).hexdigest()
                rows.append((0 if n == 0 else n.bit_length() * 16 + (n << 5 >> n.bit_length()), digest[:2], n, digest, doc_id, i))
        name = "n" if source is None else f"s{source}"
        rate = float(target[source]) / own[source] if own[source] else 0.0
        best = None
        for k in range(16):
            start = int(hashlib.md5(f"offset:{seed}:{k}:{name}".encode()).hexdigest()[:8], 16) / 4294967296.0
            copies = {row[-1]: math.floor(at * rate + start) - math.floor((at - 1) * rate + start) for at, row in enumerate(sorted(rows), 1)}
            off = abs(sum(sizes[i] * c for i, c in copies.items()) - float(target[source]))
            if best is None or off < best[0]:
                best = off, copies
        for i, c in best[1].items():
            out[i] = c
    return out
