"""The operators' results by plain Python over lists, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
import xxhash
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text: str | None, lower: bool = False) -> list[str]:
    text = (text or "").translate(LOWER) if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def roots(n: int, links) -> list[int]:
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def near_duplicates(docs: list[tuple], n: int, percent: int) -> dict:
    """doc_id -> (n_shingles, component_id, kept), for distinct ids."""
    docs = sorted(docs)
    sets = []
    for _, text in docs:
        w = words(text, lower=True)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    links = [(i, j) for j in range(len(docs)) for i in range(j)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return {docs[i][0]: (len(sets[i]), docs[r][0], r == i) for i, r in enumerate(roots(len(docs), links))}


def substrings(docs: list[tuple], n: int) -> list[tuple]:
    """Sorted (doc_id, n_words, n_removed, kept_sha256) of every row."""
    first: dict = {}
    for id_, text in docs:
        w = words(text)
        for k in range(len(w) - n + 1):
            if id_ is not None:
                key = tuple(w[k : k + n])
                first[key] = min(first.get(key, id_), id_)
    out = []
    for id_, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if id_ is not None and first[tuple(w[k : k + n])] < id_:
                gone[k : k + n] = [True] * n
        out.append((id_, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return sorted(out, key=repr)


def contamination(docs: list[tuple], items: list[tuple], span: int = 10) -> list[tuple]:
    """Sorted (doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = defaultdict(set)
    for item, text in items:
        w = find((text or "").translate(LOWER))
        for k in range(max(1, len(w) - span + 1) if w else 0):
            windows[tuple(w[k : k + span])].add(item)
    out = []
    for id_, text in docs:
        w, hit, found = find((text or "").translate(LOWER)), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    found |= windows[tuple(w[k : k + size])]
                    hit.update(range(k, k + size))
        named = sorted(str(x) for x in found if x is not None)
        out.append((id_, len(w), len(hit), len(named), sha(",".join(named)), bool(hit)))
    return sorted(out, key=repr)


def vectors(rows: list[tuple], least: float) -> dict:
    """vec_id -> (n_links, component_id, kept), for distinct ids."""
    rows = sorted(rows, key=lambda r: r[0])

    def usable(v) -> bool:
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b) -> float:
        return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    links = [(i, j) for j, (_, v, x) in enumerate(rows) for i, (_, u, y) in enumerate(rows[:j])
             if x is not None and x == y and usable(u) and usable(v) and len(u) == len(v) and cosine(u, v) >= least]
    count = Counter(k for link in links for k in link)
    return {rows[i][0]: (count[i], rows[r][0], r == i) for i, r in enumerate(roots(len(rows), links))}


def language_model(docs: list[tuple], trained) -> tuple[list[tuple], list[tuple]]:
    """Whole numbers (doc_id, n_tokens, n_known, train_tokens) and (base_score, score) of every row, in order."""
    texts = [words(t, lower=True) for _, t in docs]
    tokens, pairs, states, kinds = Counter(), Counter(), Counter(), Counter()
    for (id_, _), w in zip(docs, texts, strict=True):
        if trained(id_):
            for p, q in zip([0, *w], [*w, 1], strict=True):
                tokens[q] += 1
                pairs[p, q] += 1
                states[p] += 1
    for p, _ in pairs:
        kinds[p] += 1
    n1, n2 = (sum(c == k for c in pairs.values()) for k in (1, 2))
    discount = min(0.95, max(0.05, n1 / max(1, n1 + 2 * n2)))
    total, whole, scores = sum(tokens.values()), [], []
    for (id_, _), w in zip(docs, texts, strict=True):
        base = score = 0.0
        for p, q in zip([0, *w], [*w, 1], strict=True):
            unigram = (tokens[q] + 0.5) / (total + 0.5 * (len(tokens) + 1))
            base += math.log10(unigram)
            failure = discount * kinds[p] / states[p] if states[p] else 1.0
            arc = max(0, pairs[p, q] - discount) / states[p] if pairs[p, q] else 0.0
            score += math.log10(arc + failure * unigram)
        whole.append((id_, len(w) + 1, sum(tokens[q] > 0 for q in [*w, 1]), total))
        scores.append((base, score))
    return whole, scores


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def normal_line(line: str) -> str:
    return re.sub(r"[ \t\r]+", " ", line).lower().strip(" ")


def simhash(words: set[str]) -> int:
    """Majority of the words' hashes in each of 64 places."""
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) > len(hashes) // 2)


def compared(x: str, y: str) -> bool:
    """Whether the rule of candidates holds: short lines always; others by their SimHashes, beginnings, ends and words but one."""
    if max(len(x), len(y)) < 40:
        return True
    p, q = x.split(" "), y.split(" ")
    differ = simhash(set(p)) ^ simhash(set(q))
    equal = sum(differ >> 8 * i & 255 == 0 for i in range(8))
    k, m = (1 << (max(len(w), 8) // 4).bit_length() - 1 for w in (p, q))
    ends = p[:k] == q[:m] or p[-k:] == q[-m:]
    without = max(len(x), len(y)) < 112 and bool(set(all_but_one(p)) & set(all_but_one(q)))
    return differ.bit_count() <= 16 and equal >= (0 if without else 1 if ends else 2)


def all_but_one(words: list[str]) -> list[tuple]:
    return [tuple(words), *(tuple(words[:i] + words[i + 1 :]) for i in range(len(words)))]


def similar_lines(spark, docs: list[tuple], distance: int = 10, candidates: bool = True) -> dict[str, int]:
    """Group of each distinct normalised line: all pairs whose edit distance is at most a tenth of the longer one's length.

    With ``candidates``, the rule of candidates must hold as well.
    """
    norms = sorted({normal_line(x) for _, t in docs for x in (t or "").split("\n")} - {""})
    lines = spark.createDataFrame(list(enumerate(norms)), "i int, x string").repartition(8).cache()
    most = f"cast(greatest(length(p.x), length(q.x)) div {distance} as int)"
    near = lines.alias("p").join(lines.alias("q")).where(f"p.i < q.i and abs(length(p.x) - length(q.x)) <= {most}")
    links = near.where(f"levenshtein(p.x, q.x, {most}) >= 0").selectExpr("p.i", "q.i as j").collect()
    links = [(i, j) for i, j in links if not candidates or compared(norms[i], norms[j])]
    return dict(zip(norms, roots(len(norms), links), strict=True))


def lines(docs: list[tuple], group: dict[str, int]) -> dict:
    """doc_id -> (n_lines, n_removed, text), for distinct ids; ``group`` comes from :func:`similar_lines`."""
    seen, out = set(), {}
    for id_, text in sorted(docs, key=lambda d: d[0]):
        kept = []
        parts = (text or "").split("\n")
        for line in parts:
            g = group.get(normal_line(line))
            if g is None or g not in seen:
                kept.append(line)
            seen.add(g)
        out[id_] = (len(parts) if text is not None else 0, len(parts) - len(kept), "\n".join(kept) if text is not None else None)
    return out


def fold(doc_id, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def trigram_buckets(word: str, bits: int = 17) -> list[int]:
    """Hashed trigrams of a word between two spaces (SplitMix64's finaliser over three code points)."""
    out, full = [], (1 << 64) - 1
    for a, b, c in zip(" " + word, word, word[1:] + " "):
        x = (ord(a) | ord(b) << 21 | ord(c) << 42) & full
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
        out.append((x ^ (x >> 31)) >> (64 - bits))
    return out


def trigram_model(rows, langs, bits: int = 17):
    """Log probability of a bucket in each language, as a function."""
    import regex

    counts = {lang: Counter() for lang in langs}
    for text, lang in rows:
        for word, n in Counter(regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower())).items():
            for bucket in trigram_buckets(word, bits):
                counts[lang][bucket] += n
    total = {lang: sum(c.values()) + 0.5 * (1 << bits) for lang, c in counts.items() if lang in counts}
    return lambda bucket, lang: math.log((counts[lang][bucket] + 0.5) / total[lang])


def _ratios(seen, table, langs):
    """Each word's likelihood by language over that of its best, e**-12 at least; and the words' counts."""
    import numpy as np

    logs = np.array([[sum(table(b, lang) for b in trigram_buckets(w)) for lang in langs] for w in seen])
    return np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -12.0)), np.array(list(seen.values()), float)


def _penalised(q, c, p, n: int) -> float:
    import numpy as np

    return float((c * np.log(q @ p)).sum()) - 0.5 * math.log(c.sum() + 1) * (n - 1)


def language_sets(seen, table, langs):
    """Every set of languages, fitted by EM: (penalised likelihood, shares by language) by set."""
    import numpy as np
    from itertools import combinations

    q, c = _ratios(seen, table, langs)
    out = {}
    for n in range(1, len(langs) + 1):
        for some in combinations(range(len(langs)), n):
            p = np.zeros(len(langs))
            p[list(some)] = 1 / n
            for _ in range(1 if n == 1 else 300):
                r = p * q
                p = (r / r.sum(axis=1, keepdims=True) * c[:, None]).sum(axis=0) / c.sum()
            out[frozenset(langs[i] for i in some)] = _penalised(q, c, p, n), {langs[i]: float(p[i]) for i in some}
    return out
