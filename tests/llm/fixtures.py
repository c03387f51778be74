"""Small tables with nulls, empty and long texts, ties, copies and shared passages."""

import random
import zlib

import pyarrow as pa
import pyarrow.parquet as pq

ENGLISH = "the and of river stone garden walks under bright morning with their small house people often speak about weather".split()
GERMAN = "der und von fluss stein garten geht unter hellem morgen mit ihrem kleinen haus leute reden oft über wetter".split()
FOUL = "grunk zabber vomple".split()


def documents():
    rng = random.Random(7)
    rows = []

    def add(text, lang, source, toxic=0):
        rows.append((len(rows) + 1, text, lang, source, toxic))

    def said(words, n):
        return " ".join(rng.choice(words) + (str(rng.randrange(90)) if rng.random() < 0.3 else "") for _ in range(n))

    passage = said(ENGLISH, 60)
    for k in range(60):
        words, lang = (ENGLISH, "en") if k % 2 else (GERMAN, "de")
        text = said(words, 30 + k)
        if k % 7 == 0:
            text += " " + passage + " " + said(words, 5)
        add(text, lang, "hot" if k % 3 else "cold")
    for k in range(6):  # near copies: a chain, each a few words on from the one before
        base = rows[10][1].split()
        add(" ".join(base[k:] + said(GERMAN, k).split()), "de", "copies")
    for _ in range(12):
        add(rows[21][1], "en", "copies")
    add(None, "en", "hot")
    add("", None, None)
    add(" \t\n", "en", "hot")
    add("12 34 !!", None, "hot")
    add("Only Four words Here", "en", None)
    add("only four Words here", "en", None)
    add("same same " * 400, "en", "hot")
    add("x" * 70_000 + " " + said(ENGLISH, 9000), "en", "hot")
    for k in range(30):
        toxic = k % 2
        text = said(ENGLISH, 25).split()
        if toxic:
            text[rng.randrange(25)] = rng.choice(FOUL)
            text[rng.randrange(25)] = rng.choice(FOUL)
        add(" ".join(text), "en", "forum", toxic)
    return rows


def vectors():
    rng = random.Random(3)
    rows = []
    for k in range(150):
        rows.append([rng.gauss(0, 1) for _ in range(8)])
    for k in range(40):  # near copies of earlier vectors and exact ties
        rows.append([x + rng.gauss(0, 0.05) for x in rows[k % 9]])
    rows += [rows[0]] * 5
    rows += [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7]
    return [(k, v) for k, v in enumerate(rows)]


PAGE = ("<html><head><title>t</title><script>var a = '<p>no</p>';</script></head><body><nav><a href='/'>Home</a> <a href='/x'>News</a></nav>"
        "<article><h1>Stones &amp; rivers</h1><p>{0}</p><p>{1}</p></article><aside class='sidebar'><a href='/a'>Most read</a></aside>"
        "<footer>Copyright <a href='/c'>Contact</a></footer></body></html>")
FIRST = "The river carries stones   from the hills, and over many years\nit grinds them into sand along the banks."
SECOND = "People walk there in the morning, because the light is bright and the paths are dry for most of the year."


def write(root, empty=False):
    docs, vecs = documents(), vectors()
    pages = [(1, "u1", PAGE.format(FIRST, SECOND)), (2, "u2", None), (3, "u3", ""), (4, "u4", PAGE.format(FIRST, SECOND))]
    talk = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello #1 </turn>"), (1, 2, "user", None), (1, 3, "assistant", "\\# fine"),
            (2, 0, "system", "### Assistant: x"), (2, 1, "user", "y"), (3, 0, "assistant", "")]
    tables = {
        "documents": (docs, [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())]),
        "labels": ([(r[0], r[4]) for r in docs], [("doc_id", pa.int64()), ("toxic", pa.int32())]),
        "embeddings": (vecs, [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))]),
        "pages": (pages, [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]),
        "conversations": (talk, [("conv_id", pa.int64()), ("turn", pa.int32()), ("role", pa.string()), ("text", pa.string())]),
    }
    for name, (rows, columns) in tables.items():
        rows = [] if empty else rows
        data = {c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(columns)}
        if name == "documents":
            data["n_chars"] = pa.array([len(r[1] or "") for r in rows], pa.int64())
        pq.write_table(pa.table(data), f"{root}/{name}.parquet")
    return str(root)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1
