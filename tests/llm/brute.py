"""Plain answers to hold the text operators against, and the small tables they run on."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TABLES = {
    "documents": pa.schema(
        [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
    ),
    "labels": pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]),
    "pages": pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]),
    "benchmark": pa.schema([("item_id", pa.int64()), ("text", pa.string())]),
    "conversations": pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]),
}
# Columns that the operators use inside; tables may have them already.
CLASHING = ["id", "node", "norm", "hash", "size", "bucket", "row", "items", "kept", "shard", "rank", "start", "places", "word", "label_id", "n", "form", "depth", "conv", "counts", "kept_id", "a.b", "line"]


def words(text: str | None) -> tuple[str, ...]:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return tuple(ALNUM.findall(lowered))


def write_tables(folder, rows: dict[str, list[tuple]], clashing: bool = False) -> str:
    """Parquet tables of the given rows; a table not named is empty."""
    for name, schema in TABLES.items():
        columns = list(zip(*rows.get(name, []), strict=True)) or [[] for _ in schema]
        table = pa.table({f.name: pa.array(c, f.type) for f, c in zip(schema, columns, strict=True)}, schema=schema)
        if clashing:
            for column in CLASHING:
                table = table.append_column(column, pa.array(["x"] * len(table), pa.string()))
        pq.write_table(table, f"{folder}/{name}.parquet")
    return str(folder)


def prose(rng: random.Random, count: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def edge_documents() -> list[tuple]:
    """Nulls everywhere, empty and very long texts, ties and repeated rows, near copies, shared passages."""
    rng = random.Random(5)
    passage, long_text, base = prose(rng, 60), prose(rng, 30_000, 10**6), prose(rng, 300)
    texts = [
        None, "", "   ", "\n\t", "###", "***", "a", "one two three four", "one two three four", base, base,
        base.replace(" ", "  \n", 40), long_text, long_text + " end", prose(rng, 80) + " " + passage,
        passage + "\n" + prose(rng, 90), passage.upper(), passage + " " + passage, "same " * 200, "same " * 150,
        "Licensed under CC BY-NC 4.0. All rights reserved.", "GNU General Public License, version 3, cc by",
        "!! " * 30, "AA BB CC\n" * 12, "| a b\n" * 3 + "x y z | c d e f g", "1 2 3 4 5 6 7 8 9 10 11 12", " \n a b\n\n a b \n a b\r\nq\n", "ab " * 9 + "cd",
        "Ünïcode wörds äre kept — « quoted » ünïcode\u00a0x", prose(rng, 19), prose(rng, 20),
    ]
    for k in range(6):  # near copies, each with one word changed
        changed = base.split()
        changed[20 + 40 * k] = f"new{k}"
        texts.append(" ".join(changed))
    rng = random.Random(21)
    for k in range(12):  # spelling variants, a third of all words the same one
        said = ["Reference"] * 12 + ["referenze", "refference", "aaaaaaa", "AAAAAAAA", "aaaaaaaaa", "baaaaaaa", "\u00c9clairage", "\u00e9clairage", "eclairage"]
        said += ["preference" * 30, "preference" * 15 + "x" + "preference" * 15, "preferences", "preference"]
        texts.append(" ".join(rng.choice(said) for _ in range(40 + k)))
    rows = [(i, t, "en", f"src{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], rows[12]]  # rows repeated as they are
    rows += [(None, base, None, None, None), (None, "no id here at all in this row", "de", None, 5), (None, None, None, None, None)]
    rows += [(None, " ".join([*base.split()[:-1], "other"]), None, "src2", 4)]  # a near copy without an id
    nameless = prose(rng, 18)
    rows += [(None, nameless, "en", "src3", 4), (None, nameless, "en", "src3", 4), (None, nameless + " more", "en", None, 4)]
    rows += [(7, "another text under an id that is taken already", "fr", "src1", 40), (100, prose(rng, 50), None, "src9", None)]
    return rows


def edge_conversations() -> list[tuple]:
    """Nulls everywhere, ties, repeated rows, absent and short first conversations, copies, one long conversation."""
    rng = random.Random(15)
    said = [prose(rng, n) for n in (0, 1, 3, 8, 20)]
    rows = []
    for c in range(130):
        start = 2 if c in (20, 40) else 0
        length = {0: 6, 20: 1, 60: 2, 100: 5, 101: 90}.get(c, rng.randrange(1, 9))
        if c == 80:
            continue  # the others of its twenty have no first conversation
        for t in range(start, start + length):
            rows.append((c, t, ("user", "assistant")[t % 2], said[0 if c % 3 else rng.randrange(5)]))
    for c in range(200, 240):  # copies of one conversation
        rows += [(c, t, "user", said[t % 5]) for t in range(12)]
    rows += [(300, None, None, None), (300, None, "user", "b a"), (300, 1, None, None), (300, 1, "user", None), (300, 1, "user", "x y")]
    rows += [rows[3], rows[3], rows[-1], (None, 1, "user", "nobody said this"), (None, None, None, None)]
    rows += [(-7, 0, "user", "minus"), (-7, 1, "user", "two words"), (-20, 5, "user", "below")]
    rng.shuffle(rows)
    return rows


def edge_tables(folder) -> str:
    docs = edge_documents()
    item = docs[14][1]
    labels = [(i, 1 - (i % 5 == 0), int(i % 7 == 0)) for i in range(25)] + [(3, None, 0), (None, 1, 0), (4, 1, 1), (4, 1, 1), (999, 1, 0)]
    urls = [
        None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?y#z", "https://example.org/en/1", "http://org", "x://a://b/c",
        "http://u:p@www.x.co.uk:80/a", "http://1.2.3.4/x", "http://www.b.com/fr/1", "http://www.b.com/de/", "http://q.net?x=/a", "//b.com/",
    ]
    pages = [(100 + i, f"http://h{i % 3}.net/{i}", f"<article><h1>x</h1>{r[1]}</article>") for i, r in enumerate(docs[6:30])]
    pages += [(100, "http://h9.net/", f"<article>{docs[10][1]}</article>"), (None, "http://h1.net/", f"<article>{docs[9][1]}</article>")]
    pages += [(i, u, None) for i, u in enumerate(urls)] + [(5, urls[5], "x"), (None, "http://x.net/a", None)]
    benchmark = [(1, " ".join(item.split()[80:])), (2, None), (3, ""), (None, prose(random.Random(8), 30)), (4, "what is it? a thing of its own kind")]
    return write_tables(folder, {"documents": docs, "labels": labels, "pages": pages, "benchmark": benchmark, "conversations": edge_conversations()}, clashing=True)


def similar(rows: list[tuple[int | None, str | None]], threshold: float = 0.8, gram: int = 5) -> list[tuple]:
    """(id, class_id, text_id, copies, n_links) of every row."""
    key = [words(t) or (t or "").encode() for _, t in rows]
    copies, names = Counter(key), defaultdict(list)
    for (i, _), k in zip(rows, key, strict=True):
        if i is not None:
            names[k].append(i)
    texts = list(copies)
    sets = [set() if isinstance(k, bytes) else {k[j : j + gram] for j in range(max(1, len(k) - gram + 1))} for k in texts]
    parent, links = list(range(len(texts))), Counter()

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        shared = len(sets[a] & sets[b])
        if shared and shared >= threshold * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    at, least = {k: i for i, k in enumerate(texts)}, defaultdict(list)
    for i, k in enumerate(texts):
        least[find(i)] += names[k]
    return [
        (i, min(least[find(at[k])], default=None), min(names[k], default=None), copies[k], links[at[k]])
        for (i, _), k in zip(rows, key, strict=True)
    ]


def leaks(text: str | None, items: list[tuple[int | None, str | None]]) -> list[int | None]:
    """Items that stand in the text word by word."""
    own = [w.lower() for w in ALNUM.findall((text or "").lower())]
    found = []
    for item, said in items:
        wanted = ALNUM.findall((said or "").lower())
        n = len(wanted)
        if n and any(own[k : k + n] == wanted for k in range(len(own) - n + 1)):
            found.append(item)
    return found


def partial_leaks(text: str | None, items: list[tuple[int, str]]) -> list[int]:
    """Items without question marks of which some passage holds half of the 5-grams of both halves, or 13 words in a row."""

    def grams(said: list[str], n: int) -> set[tuple[str, ...]]:
        return {tuple(said[k : k + n]) for k in range(len(said) - n + 1)}

    own = ALNUM.findall((text or "").lower())
    wanted = {item: ALNUM.findall(said.lower()) for item, said in items}
    step = max(64, *map(len, wanted.values()))
    passages = [own[k : k + 2 * step] for k in range(0, max(len(own) - step, 1), step)]
    found = []
    for item, said in wanted.items():
        halves = [h for h in (said[: len(said) // 2], said[len(said) // 2 :]) if h]
        run = min(13, len(said))
        for passage in passages:
            held = all(
                2 * len(grams(h, n) & grams(passage, n)) >= len(grams(h, n)) for h in halves for n in [min(5, len(h))]
            )
            if held or grams(said, run) & grams(passage, run):
                found.append(item)
                break
    return found


def trie(turns: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node of ordered turns."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, said in turns.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].add(c)
        ends[tuple(said)].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].split()) for n in below if n)
        ids = ",".join(map(str, sorted(ends[node])))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below), leaves, saved, hashlib.sha256(ids.encode()).hexdigest(),
        ))
    return out


def rows_of(df) -> list[str]:
    return sorted(repr(dict(sorted(r.asDict().items()))) for r in df.collect())
