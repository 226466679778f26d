"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import regex
import sentencepiece
import tiktoken

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def part(doc_id, modulus=7):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def interpolated(rows, held=2, tuning=5, order=3):
    """Per row: (n_tokens, n_known, train_tokens, base_score, score); exact EM, order by order."""
    texts = [(part(i), SPACE_WORD.findall(lower(x)) + ["\n"]) for i, x in rows]

    def grams(t, n):
        return zip(*[(["\r"] * (n - 1) + t)[k:] for k in range(n)])

    def counts(parts):
        found = Counter()
        for p, t in texts:
            if p in parts:
                found[()] += 1  # texts, the count of each context of starts only
                for n in range(1, order + 1):
                    found.update(grams(t, n))
        return found

    train = set(range(7)) - {held}
    all_, main = counts(train), counts(train - {tuning})
    n = sum(len(t) for p, t in texts if p in train)
    base = n + sum(len(g) == 1 for g in all_) + 1

    def estimate(count, t, i, weights):
        p = (count[t[i],] + 1) / base
        for k, weight in enumerate(weights, 2):
            before = count[()] if i == 0 else count[tuple((["\r"] * k + t)[i + 1 : i + k])]
            own = count[tuple((["\r"] * k + t)[i + 1 : i + k + 1])]
            w = weight.get(int(math.log2(before + 1)), 0) if before else 0
            p = w * own / max(before, 1) + (1 - w) * p
        return p

    weights = []
    for k in range(2, order + 1):
        seen = []
        for t in (t for p, t in texts if p == tuning):
            for i in range(len(t)):
                before = main[()] if i == 0 else main[tuple((["\r"] * k + t)[i + 1 : i + k])]
                if before:
                    own = main[tuple((["\r"] * k + t)[i + 1 : i + k + 1])]
                    seen.append((int(math.log2(before + 1)), own / before, estimate(main, t, i, weights)))
        weight = dict.fromkeys({b for b, _, _ in seen}, 0.5)
        for _ in range(200):
            share, size = Counter(), Counter()
            for b, high, low in seen:
                share[b] += weight[b] * high / (weight[b] * high + (1 - weight[b]) * low)
                size[b] += 1
            weight = {b: min(share[b] / size[b], 1 - 1e-6) for b in size}
        weights.append(weight)
    return [
        (
            len(t), sum(all_[w,] > 0 for w in t), n,
            sum(math.log10((all_[w,] + 1) / base) for w in t),
            sum(math.log10(estimate(all_, t, i, weights)) for i in range(len(t))),
        )
        for _, t in texts
    ]


PHRASES = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
    "mit license": "mit",
}


def licences(text):
    w, at, labels = ALNUM_WORD.findall(lower(text)), [], set()
    for phrase, label in PHRASES.items():
        q = phrase.split()
        for i in range(len(w) - len(q) + 1):
            if w[i : i + len(q)] == q:
                at.append(i)
                labels.add(label)
    ends = (min(at), max(at)) if at else (None, None)
    return len(w), len(at), *ends, ",".join(sorted(labels))


def notices_found(texts, notices, rare=6, every=10, least=0.7):
    """Per text: labels and score, and the places (label, word, score), by trying every offset."""
    texts = [ALNUM_WORD.findall(lower(x)) for x in texts]
    df = Counter(w for t in texts for w in set(t))
    out = []
    for t in texts:
        places = set()
        for n in notices:
            own, key = n.text.split(), n.key.split()
            idf = {w: math.log(1 + (len(texts) + 1) / (df[w] + 1)) for w in own}
            top = sorted(idf, key=lambda w: (-idf[w], w))[: max(rare, len(own) // every)]
            whole = sum(idf[w] for w in top)
            key_at = next(i for i in range(len(own)) if own[i : i + len(key)] == key)
            for start in (i - key_at for i in range(len(t)) if t[i : i + len(key)] == key):
                met = {w for p, w in enumerate(own) if 0 <= start + p < len(t) and t[start + p] == w}
                score = sum(idf[w] for w in top if w in met) / whole
                if score >= least - 1e-9:
                    places.add((n.label, start, round(min(score, 1.0), 9)))
        out.append(sorted(places))
    return out


def archive(pages):
    """{page_id: (bytes, digest, type, refers_to)} for distinct ids."""
    first = {}
    for i, x in pages:
        first[x or ""] = min(first.get(x or "", i), i)
    out = {}
    for i, x in pages:
        data = (x or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        f = first[x or ""]
        out[i] = (len(data), digest, *(("response", None) if f == i else ("revisit", f)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def personal(text):
    """Base spans as kind:start:end, by start, then kind."""
    spans = []
    for k, (kind, pattern) in enumerate(KINDS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))


def quality(text):
    x = text or ""
    w = SPACE_WORD.findall(x)
    grams = list(zip(w, w[1:], w[2:]))
    often, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [line for line in x.split("\n") if SPACE_WORD.search(line)]
    counts = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x),
              len(lines) - len(set(lines)), len(inside))
    return *counts, len(w) < 50 or 100 * len(inside) > 50 * len(w)


SCRIPT_ENDS = [
    (0x41, None), (0x5B, "latin"), (0x61, None), (0x7B, "latin"), (0xC0, None), (0x280, "latin"),
    (0x340, None), (0x400, "greek"), (0x500, "cyrillic"), (0x3000, "other"), (0xE000, "east_asian"),
]
FIRST = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
    RANKS = {base64.b64decode(t): int(r) for t, r in (x.split() for x in file if x.strip())}
SECOND = tiktoken.Encoding(
    "second", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


def fertility(text, rules):
    """(tokens, byte tokens, entropy, tokens of the second vocabulary, script, kept) of a text."""
    x = text or ""
    w = SPACE_WORD.findall(x)
    ids = [i for word in w for i in FIRST.encode(word)]
    n, counts = len(ids), Counter(ids)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    second = sum(len(SECOND.encode_ordinary(" " + word)) for word in w)
    scripts = Counter(next((s for end, s in SCRIPT_ENDS if ord(c) < end), None) for c in x)
    del scripts[None]
    order = ["latin", "cyrillic", "greek", "east_asian", "other"]
    script = min(scripts, key=lambda s: (-scripts[s], order.index(s)), default="other")
    band, tokens = rules.bands[script], max(n, 1)
    usual = most = math.log2(max(n, 2))
    if rules.usual:
        size, points = math.log2(tokens), list(rules.usual)
        usual = points[-1][1]
        if size < points[0][0]:
            usual = size * points[0][1] / points[0][0]
        for (a, b), (c, d) in zip(points, points[1:]):
            if a <= size < c:
                usual = b + (size - a) * (d - b) / (c - a)
        usual = max(usual, 1.0)
    chars = sum(map(len, w)) / tokens
    bytes_ = sum(FIRST.is_byte(i) for i in ids)
    kept = (
        not quality(x)[-1] and band.chars_least <= chars <= band.chars_most
        and bytes_ / tokens <= band.byte_share_most and entropy / most >= band.entropy_least
        and entropy / usual >= band.usual_least and n / max(second, 1) >= band.ratio_least
    )
    return n, bytes_, entropy, second, script, kept


def disclosures(rows, least=0.4, remove_at=0.43):
    """Per row the sorted term spans (start, end, label) of its text."""
    held, words = {}, {}
    for _, x in rows:
        x = x or ""
        spans = [s.split(":") for s in personal(x).split(",") if s]
        held[x] = [(kind, int(a), int(b)) for kind, a, b in spans]
        words[x] = [(m[0].lower(), m.start(), m.end()) for m in regex.finditer(r"[\p{L}\p{N}]+", x)]
    df_term, df_entity, co = Counter(), Counter(), Counter()
    entities = {x: {f"{k}:{x[a:b].lower()}" for k, a, b in own} for x, own in held.items()}
    for x in held:
        terms = {w for w, _, _ in words[x]}
        df_term.update(terms)
        df_entity.update(entities[x])
        co.update((t, e) for t in terms for e in entities[x])
    total = len(held)

    def score(t, e):
        n, m = co[t, e], min(df_term[t], df_entity[e])
        if n == total:
            return 0.0
        part = min(1.0, math.log(n * total / (df_term[t] * df_entity[e])) / math.log(total / n))
        return part * n / (n + 1) * m / (m + 1)

    out = []
    for _, x in rows:
        x, spans = x or "", []
        for t, a, b in words[x]:
            best = max((score(t, e) for e in entities[x]), default=0.0)
            if best >= least and not any(c < b and a < d for _, c, d in held[x]):
                number = regex.fullmatch(r"\p{N}+", t)
                spans.append((a, b, "" if best >= remove_at else "[NUMBER]" if number else "[WORD]"))
        out.append(spans)
    return out


def overlaps(docs, items, window=10):
    """Per row: (n_words, n_hit, sorted item ids)."""
    found = defaultdict(set)
    for i, x in items:
        w = ALNUM_WORD.findall(lower(x))
        for j in range(max(1, len(w) - window + 1) if w else 0):
            found[tuple(w[j : j + window])].add(i)
    out = []
    for _, x in docs:
        w, ids = ALNUM_WORD.findall(lower(x)), set()
        hit = [False] * len(w)
        for size in {len(k) for k in found}:
            for j in range(len(w) - size + 1):
                if owners := found.get(tuple(w[j : j + size])):
                    ids |= owners
                    hit[j : j + size] = [True] * size
        out.append((len(w), sum(hit), sorted(str(i) for i in ids if i is not None)))
    return out


def components(rows, k=4, percent=85):
    """Per row: (size of the set, smallest id of its component), by comparing all pairs."""
    sets = []
    for _, x in rows:
        w = SPACE_WORD.findall(lower(x))
        sets.append({tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, s in enumerate(sets):
        for b, t in enumerate(sets[:a]):
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                top[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [
        (len(s), least.get(root(i)) if s else rows[i][0]) for i, s in enumerate(sets)
    ]


NEXT_ROLE = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def repairs(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, lines)} after damage."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        c_, t_, role, text = (" " if v is None else str(v) for v in (c, t, role, text))
        kind = zlib.crc32(f"{c_}:{t_}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[c] += [(t, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for c, own in convs.items():
        own.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, faults = set(), []
        for _, role, text in own:
            body = SPACE_WORD.findall(text)
            last = body[-1][-1] if body else ""
            faults.append(
                "b" if not body else "d" if (role, text) in seen else "t" if last not in ".!?" else ""
            )
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        best = {"": (0, "", []), "a": (0, "", []), "u": (5, "I", ["assistant:"]),
                "s": (10, "II", ["user:", "assistant:"])}
        for (_, role, text), fault in reversed(list(zip(own, faults))):
            def options(state, done, lines, cost):
                yield cost + 2 + best[state][0], done + "D" + best[state][1], lines + best[state][2]
                extra = 5 if fault == "t" else 0
                to = NEXT_ROLE[state]
                if fault not in ("b", "d"):
                    i = role[:1]
                    if i == to[0] or (i == "s" and state == ""):
                        b = best[i]
                        yield cost + extra + b[0], done + "K" + b[1], [*lines, f"{role}:{text}", *b[2]]
                    b = best[to[0]]
                    yield cost + extra + 1 + b[0], done + "R" + b[1], [*lines, f"{to}:{text}", *b[2]]
                if len(done) < 3:
                    yield from options(to[0], done + "I", [*lines, f"{to}:"], cost + 5)

            best = {state: min(options(state, "", [], 0)) for state in best}
        cost, audit, lines = best[""]
        out[c] = (gaps, *map(faults.count, "bdt"), illegal, cost, audit, lines)
    return out


def negatives(rows, positives=5, most=3):
    """Sorted (anchor, positive, rank, negative, positive score, negative score)."""
    own = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)
        if row not in own:
            own.append(row)
    out = []
    for a in own:
        if a[0] % 50:
            continue
        scores = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b) for b in own]
        near = sorted(s[:2] for s in scores if s[2][1] == a[1] and s[2] is not a)[:positives]
        far = sorted(s[:2] for s in scores if s[2][1] != a[1])
        for p, i in near:
            fit = [(n, j) for n, j in far if 50 * -p <= 100 * -n <= 95 * -p][:most]
            out += [(a[0], i, r, j, -p, -n) for r, (n, j) in enumerate(fit, 1)]
    return sorted(out)
