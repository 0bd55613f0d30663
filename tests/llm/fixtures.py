"""Small tables with the awkward rows: nulls, empty and very long texts, ties, repeated
rows, extra columns whose names clash with those the operators make."""

import pyarrow as pa
import pyarrow.parquet as pq

WORDS = "the of and stream table river stone light over under north south east west amber cedar".split()
PASSAGE = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima"

CLASHING = ("score", "fp", "component_id", "slot", "shard", "block", "role", "h", "_keep", "_k1", "ids", "rank")


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + "abcdefg"[(x >> 16) % 7] * ((x >> 20) % 2))
    return " ".join(out)


def documents() -> list[tuple]:
    texts = [prose(i, 40 + i) for i in range(30)]
    rows = [(i, t, "xx" if i % 2 else "yy", "s") for i, t in enumerate(texts)]
    rows += [(40, None, None, None), (41, "", "xx", "s"), (42, " \t\n", "xx", "s"), (43, "123 .,!", None, "s"),
             (44, "Über ÉTÉ Ⅷ ▁▁ 日本 🎉\x00 end ", "xx", "s"), (45, prose(3, 43), "yy", "s"),  # a copy
             (45, prose(3, 43), "yy", "s"), (45, "other text, same id", "yy", "s"),
             (None, "no id here", "yy", "s"), (None, None, None, None),
             (46, prose(99, 40_000), "xx", "hot"), (47, "x" * 200_000, "xx", "hot"),
             (48, "An idiot, a moron: " + PASSAGE.upper() + " <|endoftext|>.", "xx", "s"),
             (49, "\n\n  alpha   bravo", "yy", "s")]
    return rows


def write(folder, name: str, columns: dict) -> None:
    pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")


def tables(folder, empty: bool = False) -> str:
    rows = [] if empty else documents()
    ids, texts, langs, sources = zip(*rows) if rows else ((), (), (), ())
    write(folder, "documents", {
        "doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string()),
        "source": pa.array(sources, pa.string()), "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
        **{c: pa.array([f"own {c}"] * len(rows), pa.string()) for c in CLASHING}})
    labels = [] if empty else [(i, i % 3 == 0) for i in range(30)] + [(40, 1), (45, 0), (None, 1), (46, None), (3, 7), (999, 1)]
    write(folder, "labels", {"doc_id": pa.array([i for i, _ in labels], pa.int64()),
                             "quality": pa.array([1] * len(labels), pa.int32()),
                             "toxic": pa.array([None if t is None else int(t) for _, t in labels], pa.int32())})
    items = [] if empty else [(1, PASSAGE), (10, "alpha Bravo"), (2, None), (3, "  "), (None, "the of"), (1, PASSAGE),
                              (4, " ".join(prose(5, 45).split()[4:30]))]
    write(folder, "benchmark", {"item_id": pa.array([i for i, _ in items], pa.int64()),
                                "text": pa.array([t for _, t in items], pa.string()),
                                "score": pa.array([0.5] * len(items), pa.float64())})
    urls = [] if empty else [None, "", "no scheme", "http://EXAMPLE.net/en/a?x", "https://a.b.example.net/en", "http://net",
                             "http://x.net/", "http://notexample.com/de/1", "http://m.example.com/de/1#t", "x://y.org/fr/",
                             "x://y.org/fr", "http://example.net:80/en/", "http://example.net?/en/", "http://..net/q",
                             "http://h.com/" + "p/" * 50_000, "http://a://b.net/c"] * 2
    write(folder, "pages", {"page_id": pa.array(range(len(urls)), pa.int64()), "url": pa.array(urls, pa.string()),
                            "host": pa.array(["own"] * len(urls), pa.string())})
    nan, inf = float("nan"), float("inf")
    vectors = [] if empty else [(i, [float((i * k * 31) % 17) - 8, float((i * i + k) % 5), float(i % 3) - 1, 0.5])
                                for i in range(120) for k in (3,)]
    vectors += [] if empty else [(200, None), (220, []), (240, [0.0] * 4), (260, [1.0, nan, 0.0, 0.0]), (280, [inf, 0.0, 0.0, 1.0]),
                                 (300, [1.0, None, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0]), (20, vectors[20][1])]
    vectors += [] if empty else [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(400, 460)]  # copies, more than a result holds
    write(folder, "embeddings", {"vec_id": pa.array([i for i, _ in vectors], pa.int64()),
                                 "embedding": pa.array([v for _, v in vectors], pa.list_(pa.float32())),
                                 "label": pa.array([0] * len(vectors), pa.int32()),
                                 "rank": pa.array([0] * len(vectors), pa.int32())})
    return str(folder)
