"""Plain versions of the operators' contracts, without Spark and without their methods."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

_lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def crc(key, mod):
    return zlib.crc32(("" if key is None else str(key)).encode()) % mod


def ascii_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", _lower(text))


def fingerprint(text, shingle=3):
    w = ascii_words(text)
    grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, radius=3):
    """For each fingerprint the least place it reaches."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text))


def contamination(text, items):
    w = bench_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = bench_words(item)
        if item_id is None or not v:
            continue
        n = min(10, len(v))
        for i in range(len(v) - n + 1):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item_id))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def url_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = _lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host):])[0]
    best = None
    for verdict, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, *(best or (None, "allow"))


def base_scores(rows):
    """(n_tokens, n_known, N, base score) of (doc_id, text) rows."""
    toks = [ascii_words(t) + [None] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, toks) if crc(i, 7) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws in toks]
