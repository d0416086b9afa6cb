"""Straightforward versions of the operators, for small tables."""

from collections import Counter
import hashlib
import math
import re
import zlib

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def base_rules(text):
    text = text or ""
    words = SPACED.findall(text)
    three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = {t: three.count(t) for t in set(three)} if len(three) < 3000 else {}
    inside = set()
    for i, t in enumerate(three):
        if times.get(t, 0) > 1:
            inside.update((i, i + 1, i + 2))
    seen, dups = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dups += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(inside),
    )


def perplexities(rows, kinds, order=5):
    """``{(lang, text): nats a byte}`` of a modified Kneser-Ney model of each language's distinct texts.

    ``kinds`` has the class of each byte; 0 is what comes before a text.
    """
    result = {}
    for lang in {lang for _, lang in rows}:
        texts = {t for t, of in rows if of == lang and t}
        ends = {}
        for text in texts:
            symbols = (0,) * (order - 1) + tuple(int(kinds[b]) for b in text.encode())
            ends[text] = [symbols[i : i + order] for i in range(len(symbols) - order + 1)]
        counts = {order: Counter(g for found in ends.values() for g in found)}
        for k in range(order - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        cuts, contexts = {}, {}
        for k, found in counts.items():
            seen = Counter(found.values())
            y = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] + 2 * seen[2] else None
            rough = [0.5 if y is None or not seen[n] else n - (n + 1) * y * seen[n + 1] / seen[n] for n in (1, 2, 3)]
            cuts[k] = [min(max(r, 0.1), n) for n, r in enumerate(rough, 1)]
            for g, n in found.items():
                total, cut = contexts.get(g[:-1] + (k,), (0, 0))
                contexts[g[:-1] + (k,)] = total + n, cut + cuts[k][min(n, 3) - 1]

        def chance(g):
            n, (total, cut) = counts[len(g)][g], contexts[g[:-1] + (len(g),)]
            lower = chance(g[1:]) if len(g) > 1 else 1 / 64
            return max(n - cuts[len(g)][min(n, 3) - 1], 0) / total + cut / total * lower

        logs = {g: math.log(chance(g)) for g in counts[order]}
        result |= {(lang, t): -sum(map(logs.get, found)) / len(found) for t, found in ends.items()}
    return result


def decontaminated(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOW))
        k = min(window, len(words))
        for i in range(len(words) - k + 1 if words and item is not None else 0):
            windows.setdefault(tuple(words[i : i + k]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    result = []
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for k in lengths:
            for i in range(len(words) - k + 1):
                if names := windows.get(tuple(words[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result.append((doc, len(words), len(hit), len(found), digest, bool(hit)))
    return result


def shingles(text):
    words = SPACED.findall((text or "").translate(LOW))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near(docs, percent=85):
    """For tables with one row per id."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [(d, len(sets[d]), root(d), root(d) == d) for d in ids]


def without_substrings(docs, length=50):
    first = {}
    known = [(d, (t or "").encode()) for d, t in docs]
    for d, b in known:
        if d is not None:
            for p in range(len(b) - length + 1):
                s = b[p : p + length]
                first[s] = min(first.get(s, d), d)
    result = []
    for d, b in known:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1 if d is not None else 0):
            if first[b[p : p + length]] < d:
                gone[p : p + length] = b"\x01" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        result.append((d, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return result


def held_out(doc_id, folds, which):
    return zlib.crc32(str(doc_id).encode()) % folds == which


def aligned(docs):
    """One document after another with the libraries themselves."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}

    def a_bytes(i):
        return bytes(byte_of[c] for c in first.id_to_token(i))

    def b_bytes(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("\u2581", " ").encode()

    def ends(ids, spell):
        found, at = [], 0
        for i in ids:
            at += len(spell(i))
            found.append(at)
        return found

    rows, holding = [], Counter()
    for doc, text in docs:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        ends_a, ends_b = ends(a, a_bytes), ends(b, b_bytes)
        groups = _cut(a, b, ends_a, ends_b)
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        holding.update(links.keys())
        rows.append((doc, len(a), len(b), groups, links))
    most = {}
    for (x, _), n in holding.items():
        most[x] = max(most.get(x, 0), n)
    result = []
    for doc, n_a, n_b, groups, links in rows:
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        result.append(
            (
                doc, n_a, n_b, len(groups), sum(links.values()),
                sum(n for p, n in links.items() if holding[p] == most[p[0]]),
                sum(n * holding[p] for p, n in links.items()),
                hashlib.sha256(spelled.encode()).hexdigest() if n_a else "",
            )
        )
    return result


def _cut(a, b, ends_a, ends_b):
    groups, x, y = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        i, j = x, y
        while i < len(a) and ends_a[i] <= end:
            i += 1
        while j < len(b) and ends_b[j] <= end:
            j += 1
        groups.append((a[x:i], b[y:j]))
        x, y = i, j
    return groups


LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(docs, least=30, ranks=50):
    """``docs`` are (lang, source, text)."""
    counts, held = {}, {}
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        words = Counter(LETTERS.findall((text or "").translate(LOW)))
        counts.setdefault(lang, {}).setdefault(source, Counter()).update(words)
        held.setdefault(lang, Counter()).update(words.keys())
    rows = []
    for lang, sources in counts.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        v = len(kept)

        def rates(group):
            total = sum(group[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (group[t] + 5) // (total + 5 * v) for t in kept}

        q = rates(sum(sources.values(), Counter()))
        p = {source: rates(group) for source, group in sources.items()}
        for source in sources:
            pairs = [(o, sum(abs(p[source][t] - p[o][t]) for t in kept)) for o in sources if o != source]
            terms = [(t, p[source][t] - q[t]) for t in kept if sources[source][t] and p[source][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, ranks)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                rows += [(lang, source, part, item, value, n) for n, (item, value) in enumerate(found, 1)]
    return rows


def simhash(text):
    import xxhash

    words = SPACED.findall((text or "").translate(LOW))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def within(prints, errors=4):
    """The smallest key reachable by links of at most ``errors`` differing bits."""
    root = {}
    for key in sorted(prints):
        near = {root[o] for o in root if (prints[o] ^ prints[key]).bit_count() <= errors} | {key}
        least = min(near)
        root = {o: least if r in near else r for o, r in root.items()} | {key: least}
    return root
