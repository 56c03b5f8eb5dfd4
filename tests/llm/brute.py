"""Plain Python readings of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import sentencepiece
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text, n=5):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def classes(sets, percent=75):
    """Least key that can be reached by links, for each key of {key: set}."""
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for key in sorted(sets):
        shared = Counter(other for x in sets[key] for other in holders[x])
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[key]) + len(sets[other]) - n):
                a, b = sorted((root(key), root(other)))
                parent[b] = a
        for x in sets[key]:
            holders[x].append(key)
    return {k: root(k) for k in sets}


def hits(text, items, window=10):
    """Words, hit places and items of a text; items are (id, text)."""
    words, found = LETTERS.findall((text or "").translate(LOWER)), defaultdict(set)
    for item, item_text in items:
        own = LETTERS.findall((item_text or "").translate(LOWER))
        for k in range(max(1, len(own) - window + 1) if own else 0):
            found[tuple(own[k : k + window])].add(item)
    places, met = set(), set()
    for n in {len(x) for x in found}:
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in found:
                places |= set(range(k, k + n))
                met |= found[tuple(words[k : k + n])]
    return words, places, met


def counts(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) > 15]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) > 31]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


def hard_negatives(rows, positives=5, negatives=3):
    """Rows are (id, label, vector); every pair is scored."""
    usable = []
    for i, label, vector in rows:
        if i is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        usable.append((i, label, [math.floor(256 * x) for x in vector]))
    out = []
    for at, (anchor, label, vector) in enumerate(usable):
        if anchor % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(vector, other, strict=False)), i, k, own)
            for k, (i, own, other) in enumerate(usable)
            if k != at
        ]
        scored.sort(key=lambda x: x[:3])
        for p, positive, _, _ in [x for x in scored if x[3] == label][:positives]:
            fit = [x for x in scored if x[3] != label and -50 * p <= -100 * x[0] <= -95 * p]
            for rank, (n, negative, _, _) in enumerate(fit[:negatives], 1):
                out.append((anchor, positive, rank, negative, -p, -n))
    return sorted(out)


def edited(rows):
    """{id: (n_chars, edited text, next text)} of (id, text) rows with distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(text) // 3
        out[i] = (len(text), text[: len(text) - n] + following[:n], following)
    return out


def alignment(texts, first, second):
    """Token counts, groups and links of {key: text} by walking both token lists."""
    coder = Tokenizer.from_file(first)
    coder.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=second)
    byte = {}
    extra = 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE:
            byte[chr(b)] = b
        else:
            byte[chr(extra)] = b
            extra += 1
    found, pairs = {}, Counter()
    for key, text in texts.items():
        a = coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        ab = [bytes(byte[c] for c in coder.id_to_token(i)) for i in a]
        bb = [
            bytes([int(pieces.id_to_piece(i)[3:5], 16)])
            if pieces.is_byte(i)
            else pieces.id_to_piece(i).replace("\u2581", " ").encode()
            for i in b
        ]
        data = (" " + (text or "")).encode()
        found[key] = None
        if not text or b"".join(ab) != data or b"".join(bb) != data:
            continue
        links, groups, i, j, ea, eb = [], [[[], []]], 0, 0, len(ab[0]), len(bb[0])
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            group = groups[-1]
            done_a, done_b = ea <= eb, eb <= ea
            if done_a:
                group[0].append(a[i])
                i += 1
            if done_b:
                group[1].append(b[j])
                j += 1
            if done_a and done_b:
                groups.append([[], []])
            if done_a and i < len(a):
                ea += len(ab[i])
            if done_b and j < len(b):
                eb += len(bb[j])
        groups.pop()
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        found[key] = (len(a), len(b), len(groups), links, text)
        pairs.update(links)
    best = Counter()
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    out = {}
    for key, one in found.items():
        if one is None:
            out[key] = (0, 0, 0, 0, 0, 0, "")
            continue
        n_best = sum(pairs[x] == best[x[1]] for x in one[3])
        total = sum(pairs[x] for x in one[3])
        digest = hashlib.sha256(one[4].encode()).hexdigest()
        out[key] = (*one[:3], len(one[3]), n_best, total, digest)
    return out
