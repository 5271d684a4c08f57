"""The operators against brute force, exact round trips and held-out accuracy, and on the odd cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomvault.llm import bpe, chat, decontaminate, fingerprint, html_text, langid, lines, repeats, simhash, toxicity
from loomvault.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None, "x"), (2, "", "x"), (3, "one two", None), (3, "one two", "y"), (None, "one two", "z"), (5, "a" * 70_000 + " end", "x"),
       (6, "Ä ß   é 中 <|endoftext|> \\ <turn>", "x")]
PIECES = ("the cat sat on a mat and ran off to see what was there before night fell over town hall again today "
          "while seven old ships sailed past under grey wide skies").split()


def frame(spark, rows, schema="doc_id long, text string, `n.words` string"):
    return spark.createDataFrame(rows, schema)


def words(rng, n):
    return " ".join(rng.choice(PIECES) for _ in range(n))


def test_odd_rows_pass_through_every_text_operator(spark):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    bench = spark.createDataFrame([("b", "one two"), ("c", None), ("d", "!")], "item_id string, text string")
    model = langid.language_fit(frame(spark, ODD), lang="n.words")
    runs = {
        "lines": lambda d: lines.dedup_lines(d), "repeats": lambda d: repeats.find_repeats(d), "bpe": lambda d: bpe.bpe_encode(d, path, decoded=True),
        "html": lambda d: html_text.extract_main_text(d, "text"), "toxicity": lambda d: toxicity.toxicity_score(d, (np.array([0]), np.array([0.0]))),
        "language": lambda d: langid.language_predict(d, model), "benchmark": lambda d: decontaminate.find_benchmark_text(d, bench),
        "fingerprint": lambda d: fingerprint.fingerprint(d)}
    for name, run in runs.items():
        got = run(frame(spark, ODD)).collect()
        assert len(got) == len(ODD), name
        assert sorted(map(str, (r["n.words"] for r in got))) == sorted(str(r[2]) for r in ODD), name
        assert run(frame(spark, [])).collect() == [], name
    assert len(simhash.near_duplicates(frame(spark, ODD)).collect()) == len(ODD)
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert len(fingerprint.compare_with_next(frame(spark, ODD)).collect()) == len(ODD)
    assert fingerprint.compare_with_next(frame(spark, [])).collect() == []


def test_columns_of_clashing_names_are_replaced(spark):
    got = toxicity.toxicity_score(spark.createDataFrame([(1, "x", "old")], "doc_id long, text string, Toxicity string"), (np.array([0]), np.array([0.0])))
    assert got.columns == ["doc_id", "text", "toxicity", "is_toxic"] and got.first().toxicity == 0.5
    df = spark.createDataFrame([(1, "plain words", 7)], "doc_id long, text string, n_hit long")
    kept = decontaminate.decontaminate(df, spark.createDataFrame([("b", "other")], "item_id string, text string"))
    assert [tuple(r) for r in kept.collect()] == [(1, "plain words", 7)]


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near(a, b):
    a, b = a.split(" "), b.split(" ")
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or max(len(a), len(b)) < lines.LEAST:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]


def test_lines_equal_a_comparison_of_all_pairs(spark):
    rng = random.Random(3)
    pool = [words(rng, rng.choice((1, 3, 7, 8, 9, 20))) for _ in range(25)]
    docs = []
    for i in range(40):
        own = []
        for _ in range(rng.randint(1, 5)):
            line = rng.choice(pool).split(" ")
            if rng.random() < 0.6:
                at = rng.randrange(len(line))
                line[at:at + rng.choice((0, 1))] = rng.choice(([], ["new"], ["of", "two"]))
            own.append(" ".join(line))
        docs.append((i, "\n".join(own + ["", "  "])))
    seen, expect = [], {}
    for i, text in docs:
        kept = []
        for line in text.split("\n"):
            if line.strip(" ") and any(line == s or near(line, s) for s in seen):
                seen.append(line)
                continue
            if line.strip(" "):
                seen.append(line)
            kept.append(line)
        expect[i] = "\n".join(kept)
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == expect


def test_lines_within_a_bound_that_grows_equal_all_pairs(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(12)
    pool = [words(rng, rng.choice((9, 14, 15, 16, 24, 33, 70))) for _ in range(12)] + [" ".join(["ha"] * 30)]
    docs = []
    for i in range(120):
        line = rng.choice(pool).split(" ")
        for _ in range(rng.randint(0, len(line) // 7 + 1)):
            at = rng.randrange(len(line))
            line[at:at + rng.choice((0, 1))] = rng.choice(([], ["new"], ["of", "two"]))
        docs.append((i, " ".join(line)))
    split = [(i, line, line.split(" ")) for i, line in docs]
    gone = {i for i, line, a in split if any(j < i and (line == other or distance(a, b) <= max(len(a), len(b)) // lines.LEAST) for j, other, b in split)}
    one = {i for i, line, a in split if any(j < i and (line == other or near(line, other)) for j, other, _ in split)}
    assert one < gone and len(gone) < len(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id for r in lines.dedup_lines(df, max_edits=None).filter("n_removed = 1").collect()} == gone


def test_lines_within_the_bound_share_a_run_that_both_take(spark):
    rng = random.Random(21)
    pairs = []
    for i in range(300):
        n = rng.choice((7, 8, 9, 14, 15, 16, 21, 30, 58, 63, 150))
        a = ["ha"] * n if i % 29 == 0 else words(rng, n).split(" ")
        b = list(a)
        for _ in range(max(len(a), len(b)) // lines.LEAST):
            at = rng.randrange(len(b))
            b[at:at + rng.choice((0, 1))] = rng.choice(([], [f"new{i}"], ["of"]))
        if len(b) >= 7 and abs(len(a) - len(b)) <= max(len(a), len(b)) // lines.LEAST:
            pairs.append((i, a, b))
    df = spark.createDataFrame(pairs, "i int, a array<string>, b array<string>")
    of = {c: df.select("i", F.transform(c, lambda w: F.xxhash64(w)).alias("h")) for c in "ab"}
    often = [r.x for r in of["a"].select(F.explode(F.expr(lines.RUNS)).alias("x")).distinct().orderBy("x").limit(100).collect()]
    for some in ([], often):
        taken = {c: {r.i: r.keys for r in of[c].select("i", lines._keys(some, None).alias("keys")).collect()} for c in "ab"}
        for i, a, b in pairs:
            if lev(a, b) <= max(len(a), len(b)) // lines.LEAST:
                assert set(taken["a"][i]) & set(taken["b"][i]), (a, b)
            assert len(taken["a"][i]) <= lines.RUN * (len(a) // 7) + 1


def test_words_with_one_character_are_told_apart(spark):
    numbers = spark.range(6000).select(F.concat(F.lit("w"), "id").alias("w")).groupBy(F.xxhash64("w").bitwiseAND(F.lit(0xFFFFF))).agg(F.collect_list("w").alias("ws"))
    one, other = numbers.filter("size(ws) > 1").first().ws[:2]
    a = words(random.Random(5), 16).split(" ") + [one, other]
    b = a[:-2] + [other, one]
    df = spark.createDataFrame([(a, b, 1), (a, b, 2), (a, a, 0)], "a array<string>, b array<string>, e int")
    assert [r.x for r in df.select(lines._within(F.col("a"), F.col("b"), F.col("e")).alias("x")).collect()] == [False, True, True]


def test_lines_of_repeated_rows_have_near_lines(spark):
    line, other = words(random.Random(8), 12), words(random.Random(9), 12)
    docs = [(1, line + " one")] * 3 + [(2, line + " two\n" + other + " one")] + [(4, other + " two\nalone")] * 3
    got = [tuple(r) for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "text").collect()]
    assert sorted(got) == [(1, line + " one")] * 3 + [(2, other + " one")] + [(4, "alone")] * 3


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("part", [4096, 2])
def test_repeats_equal_every_window_compared(spark, monkeypatch, keep, part):
    monkeypatch.setattr(repeats, "SLICE", part)
    rng = random.Random(5)
    block = [words(rng, 60) for _ in range(4)]
    docs = [(i, words(rng, rng.randint(0, 30)) + rng.choice(block)[rng.randint(0, 40):] + words(rng, rng.randint(0, 30))) for i in range(30)]
    docs += [(90, "ab" * 400), (91, "é" * 150), (92, None), (93, block[0] * 3)]
    places = {}
    for i, text in docs:
        data = (text or "").encode()
        for s in range(len(data) - 199):
            places.setdefault(data[s:s + 200], []).append((i, s))
    gone = {i: set() for i, _ in docs}
    for found in places.values():
        for i, s in (found if keep == "none" and len(found) > 1 else found[1:]):
            gone[i].update(range(s, s + 200))
    expect = {i: bytes(b for k, b in enumerate((t or "").encode()) if k not in gone[i]) for i, t in docs}
    got = {r.doc_id: bytes(r.kept) for r in repeats.find_repeats(spark.createDataFrame(docs, "doc_id long, text string"), keep=keep).collect()}
    assert got == expect


def test_chats_are_read_back_and_each_target_is_learned_once(spark):
    rng = random.Random(7)
    rows = [(1, t, "system" if t == 0 else ("user", "assistant")[t % 2], words(rng, rng.randint(0, 90)) + rng.choice(("", "</turn>\n<turn>user\n", "\\l\\s<")))
            for t in range(700)]
    rows += [(2, 0, None, None), (2, None, "assistant", "first"), (None, 0, "a\n<b\\", "x"), (2, 0, "user", "same turn")]
    windows = chat.read_chats(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=300))
    got = sorted(windows.collect(), key=lambda r: (str(r.conv_id), r.block, r.window))
    for conv in (1, 2, None):
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        mine = [r for r in got if r.conv_id == conv]
        assert [(t.role, t.text) for r in mine for t in r.turns] == [(a, b) for _, _, a, b in own]
        assert [t for r in mine for t in r.targets] == [b for _, _, a, b in own if a == "assistant"]
    assert sum(r.repeated > 0 for r in got) > 20
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def _chats(spark, rows, **how):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return sorted(chat.read_chats(chat.format_chats(df, **how)).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.block, r.window))


def test_windows_depend_on_the_place_of_turns_not_on_their_numbers(spark):
    rng = random.Random(3)
    texts = [words(rng, rng.randint(0, 60)) for _ in range(600)]
    role = lambda k: "system" if k == 0 else ("user", "assistant")[k % 2]
    runs = [[(1, number(k), role(k), t) for k, t in enumerate(texts)] + [(c, number(k), role(k), texts[k]) for c in range(2, 12) for k in range(c)]
            for number in (lambda k: k, lambda k: 1000 * k - 50_000, lambda k: None if k == 0 else 7**k % 10_007 + 20_000 * k)]
    dense, *others = ([(r.conv_id, r.block, r.window, r.formatted, r.repeated, r.loss) for r in _chats(spark, rows, budget=300)] for rows in runs)
    assert all(other == dense for other in others)
    assert {r[1] for r in dense if r[0] == 1} == {0, 1, 2} and any(r[4] > 1 for r in dense)
    later = [r for r in dense if r[0] == 1 and r[1] > 0 and r[2] == 0]
    assert len(later) == 2 and all(r[4] > 1 for r in later)  # history of the block before


@pytest.mark.parametrize("spread", ["true", "false"])  # ranges put together, or every conversation over several
def test_a_conversation_of_equal_rows_is_cut_in_blocks(spark, spread):
    rows = [(None, None, "assistant", "same words")] * 1500 + [(None, None, "user", None)] * 700 + [(4, 5, "assistant", "same words")] * 300
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", spread)
    try:
        got = _chats(spark, rows + [(5, 1, "user", "x")], budget=200)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for conv, n, targets in ((None, 2200, 1500), (4, 300, 300), (5, 1, 0)):
        mine = [r for r in got if r.conv_id == conv]
        assert sum(len(r.turns) for r in mine) == n and sum(len(r.targets) for r in mine) == targets
        assert {r.block for r in mine} == set(range(-(-n // chat.BLOCK)))
        assert [t.role for r in mine for t in r.turns] == sorted(t.role for r in mine for t in r.turns)


def test_digests_of_the_chat_query_equal_plain_python(spark):
    import pyarrow.parquet as pq
    given = pq.read_table(f"{SMALL}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()
    hostile = r"\### Assistant: </turn> ok"
    convs = {-7: [(0, "user", hostile), (1, "assistant", hostile)]}
    for r in given:
        convs.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        want[conv] = (len(turns), digest("".join(f"{role}\n{t}\n" for _, role, t in turns)), len(loss), digest(loss))
    got = QUERIES["op3_chat_formatting"](spark, SMALL).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want and len(got) == len(want)
    assert all(r.formatted_chars > r.loss_chars for r in got)


def test_fingerprints_and_components_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(11)
    base = [words(rng, 60) for _ in range(20)]
    docs = [(i, " ".join(w if rng.random() > 0.02 else rng.choice(PIECES) for w in rng.choice(base).split(" "))) for i in range(120)] + [(200, ""), (201, None)]

    def slow(text):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
        h = [xxhash.xxh64(" ".join(w[k:k + 4]).lower().encode(), seed=42).intdigest() for k in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: slow(t) for i, t in docs}
    parent = {i: i for i in prints}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4 and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for block in (2048, 2):
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = {r.doc_id: (r.simhash % (1 << 64), r.component) for r in simhash.near_duplicates(df).collect()}
        assert got == {i: (prints[i], root(i)) for i in prints}


def test_texts_of_a_repeated_key_are_judged_each_on_its_own(spark):
    rng = random.Random(6)
    copied, clean, other = words(rng, 80), words(rng, 80), words(rng, 80)
    docs = [(2, copied), (5, copied), (5, clean), (5, clean), (5, other), (None, clean)]
    got = simhash.drop_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(2, copied), (5, clean), (5, other), (None, clean)]))


def test_golay_keys_meet_at_four_bits():
    rng = np.random.default_rng(2)
    one = rng.integers(0, 2**63, 500, dtype=np.uint64)
    two = one.copy()
    for i in range(500):
        for b in rng.choice(64, 4, replace=False):
            two[i] ^= np.uint64(1) << np.uint64(b)
    keys = [[set() for _ in range(500)] for _ in range(2)]
    for side, values in zip(keys, (one, two)):
        for key, row in simhash.golay_keys(values.view(np.int64)):
            for k, r in zip(key.tolist(), row.tolist()):
                side[r].add(k)
    assert all(a & b for a, b in zip(*keys))


PAGE = """<html><head><title>t</title><script>var x = "<p>no</p>";</script></head><body><header><a>Home</a></header><nav><ul><li>menu</ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; shoulders</h1><p>First  <b>bold</b> text of the article that is long enough.
<p>Second<br>line with many more words than the others have in it.</p><div class="ad">buy</div><p>End.</p>
<section class="comments"><p>nice post, really long comment of a reader who goes on and on</p></section></article>
<aside>side</aside><form><input><p>mail</p></form><footer>foot</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == ("Head & shoulders\nFirst bold text of the article that is long enough.\n"
                                         "Second line with many more words than the others have in it.\nEnd.")
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("<div>un<b>closed") == "unclosed"


def test_equal_substrings_share_phrases():
    rng = random.Random(13)
    a, b = words(rng, 400), words(rng, 400)
    same, moved, other = fingerprint.sketches([a, "some other start " + a, b])
    assert fingerprint.likeness(same, moved) > 0.8 > 0.2 > fingerprint.likeness(same, other)
    assert fingerprint.sketches(["x", a])[1].tolist() == same.tolist()
    empty, letter = fingerprint.sketches(["", "a"])
    assert fingerprint.likeness(empty, empty) == 1 and fingerprint.likeness(empty, letter) == 0


def test_neighbours_in_key_order(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op6_document_fingerprints"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        cut = len(text) // 4
        changed = text[:len(text) - cut] + following[:cut]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert got[i].fingerprint == fingerprint.as_text(fingerprint.sketches([text])[0])


def test_neighbours_lie_in_as_many_tasks_as_ranges(spark):
    docs = spark.range(0, 4000).selectExpr("id AS doc_id", "concat('text of ', id) AS text")
    out = fingerprint.compare_with_next(docs).select("doc_id", F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 1.5 * 4000 / len(sizes)


def test_ftrl_equals_a_plain_loop():
    rng = random.Random(23)
    rows = [(toxicity.features(words(rng, 9) + (" nasty slur" if k % 7 == 0 else "")), int(k % 7 == 0)) for k in range(90)]
    z, n, made = {}, {}, toxicity.Ftrl()

    def weight(i):
        if abs(z.get(i, 0.0)) <= made.l1:
            return 0.0
        return -(z[i] - math.copysign(made.l1, z[i])) / ((made.beta + math.sqrt(n[i])) / made.alpha + made.l2)

    rarer = math.sqrt(sum(not y for _, y in rows) / sum(y for _, y in rows))
    for _ in range(6):
        for at, y in rows:
            own = {int(i): weight(int(i)) for i in at}
            g = (1 / (1 + math.exp(-sum(own.values()))) - y) * (max(1.0, rarer) if y else max(1.0, 1 / rarer))
            for i, w in own.items():
                was = n.get(i, 0.0)
                n[i] = was + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(was)) / made.alpha * w
    want = {i: weight(i) for i in z if weight(i)}
    at, w = toxicity.train(rows)
    assert want and set(at) == set(want) and np.allclose(w, [want[i] for i in at], atol=1e-9)


def test_toxicity_learns_from_one_row_of_each_id_wherever_it_lies(spark):
    rng = random.Random(29)
    docs = [(k, words(rng, 12) + (" nasty slur" if k % 5 == 0 else "")) for k in range(80)] + [(200, None), (201, ""), (None, "x"), (202, "long " * 40_000)]
    labels = [(k, int(k % 5 == 0)) for k in range(80)] + [(3, 0), (200, 0), (201, 0), (202, 0), (None, 1), (5, None)]
    fit = lambda rows, parts: toxicity.toxicity_fit(frame(spark, rows, "doc_id long, text string").repartition(parts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    once, often = fit(docs, 1), fit(docs * 3, 5)
    assert list(once[0]) == list(often[0]) and list(once[1]) == list(often[1]) and len(once[0]) > 1
    changed = fit(docs + [(0, "zzz nasty")] * 2, 3)  # another text of id 0: one of the two is learned from, the same in any order
    again = fit([(0, "zzz nasty"), *docs[::-1]], 2)
    assert list(changed[0]) == list(again[0]) and list(changed[1]) == list(again[1])
    none = toxicity.toxicity_fit(frame(spark, docs, "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.toxicity < 0.01 for r in toxicity.toxicity_score(frame(spark, docs, "doc_id long, text string"), none).collect())


def test_language_profiles_equal_a_plain_bundle(spark):
    rng = random.Random(31)
    alphabets = {"aa": "abcdeé", "bb": "cdefgß", "cc": "абвгд"}
    make = lambda lang, n: "".join(rng.choice(alphabets[lang] + "  1.") for _ in range(n))
    rows = [(k, make(lang, rng.choice((3, 40, 200))), lang) for k, lang in enumerate(list(alphabets) * 12)]
    odd = [(100, None, "aa"), (101, "", None), (102, "12 .", "bb"), (103, "A", None), (104, "aé bß", None), (105, make("cc", 40_000), None)]

    def bundle(text):
        total = np.zeros(langid.DIMENSIONS, np.int64)
        letters = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} "))
        for k in range(len(letters) - 2):
            bound = np.ones(langid.DIMENSIONS, np.int64)
            for place, c in enumerate(reversed(letters[k:k + 3])):
                bound = bound * np.roll(langid.letter_vector(ord(c)), place)
            total += bound
        return total

    want = {lang: sum(bundle(t) for _, t, of in rows if of == lang) for lang in alphabets}
    df = spark.createDataFrame(rows + odd[:1], "doc_id long, text string, lang string")
    names, prototypes = langid.language_fit(df)
    assert names == sorted(want) and all((prototypes[k] == want[name]).all() for k, name in enumerate(names))
    given = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").select("doc_id", "text")
    got = {r.doc_id: r for r in langid.language_predict(given, (names, prototypes)).collect()}
    assert len(got) == len(rows) + len(odd)
    for key, text, _ in rows + odd:
        own = bundle(text)
        if not any(c.isalpha() for c in text or ""):
            assert (got[key].lang_pred, got[key].lang_score) == ("und", 0.0)
            continue
        cosine = {n: own @ want[n] / np.linalg.norm(own) / np.linalg.norm(want[n]) for n in names}
        best = max(cosine.values())
        assert cosine[got[key].lang_pred] > best - 1e-5 and abs(got[key].lang_score - max(0.0, best)) < 1e-5


def test_held_out_language_and_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op7_language_id"](spark, folder).filter("held_out").collect()
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in got]) > 0.98
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    scored = [(r.score, r.predicted, toxic[r.doc_id]) for r in QUERIES["op8_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in toxic]
    assert np.mean([p == y for _, p, y in scored]) > 0.9
    assert np.mean([s for s, _, y in scored if y]) > np.mean([s for s, _, y in scored if not y]) + 0.3


def test_benchmark_windows_equal_a_plain_search():
    rng = random.Random(17)
    items = [(str(k), words(rng, rng.choice((1, 4, 13, 30)))) for k in range(12)]
    texts = [words(rng, 40) + " " + rng.choice(items)[1] + " x " + words(rng, 40) for _ in range(60)] + [None, "", "!"]

    class Held:
        value = decontaminate.Block([(i, decontaminate.words_of(t)) for i, t in items])

    for text, row in zip(texts, decontaminate.shard_matches(texts, [Held])):
        w = decontaminate.words_of(text)
        hit, found = [0] * len(w), set()
        for item, body in items:
            b = decontaminate.words_of(body)
            for k in range(max(1, len(b) - 12)):
                window = b[k:k + 13]
                for at in range(len(w) - len(window) + 1):
                    if w[at:at + len(window)] == window:
                        hit[at:at + len(window)] = [1] * len(window)
                        found.add(item)
        assert row[:2] == (len(w), sum(hit)) and row[3] == sorted(found)


@pytest.mark.parametrize("base", [0, 2**21 - 3, 2**33])
def test_benchmark_words_of_any_number_are_found(base):
    rng = np.random.default_rng(9)
    numbers = np.append(base + rng.integers(1, 5, 300), 0)
    pattern = np.array([numbers[k : k + 13] for k in (3, 40, 200, 287)] + [np.append(numbers[9:11], np.zeros(11, np.int64))])
    sizes = np.array([13, 13, 13, 13, 2])
    order = decontaminate.suffix_array(numbers, np.arange(300), 13)
    lo, hi = (decontaminate.search(numbers, order, pattern, sizes, upper) for upper in (False, True))
    for k, n in enumerate(sizes):
        assert sorted(order[lo[k] : hi[k]]) == [a for a in range(301 - n) if numbers[a : a + n].tolist() == pattern[k, :n].tolist()]


def test_benchmark_items_without_id_hit_and_matches_are_of_one_item(spark):
    one, two = words(random.Random(4), 20), words(random.Random(5), 15)
    bench = spark.createDataFrame([(None, one), ("b", two)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"{one} {two}"), (3, "x y")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find_benchmark_text(docs, bench).collect()}
    assert [(got[k].n_hit, got[k].hit_items, got[k].longest_match, got[k].contaminated) for k in (1, 2, 3)] == [
        (20, [None], 20, True), (35, ["b", None], 20, True), (0, [], 0, False)]


def test_encoding_equals_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.TrieEncoder(open(path, "rb").read())
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    texts += ["I'LL don't 'S o'clock", "a<|endoftext|>B<|startoftext|>", "ΣΑΣ İ ß ﬁ ½ ² 中文 한글", "a" * 3000, "\x1c \x85​!", "", None]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert own.encode(texts) == want
    assert [own.decode(ids) for ids in want] == [library.decode(ids, skip_special_tokens=False) for ids in want]
    df = bpe.bpe_decode(bpe.bpe_encode(frame(spark, ODD), path), path)
    assert [r.decoded for r in df.collect()] == [r.decoded for r in bpe.bpe_encode(frame(spark, ODD), path, decoded=True).collect()]


def test_pipeline_keeps_what_its_stages_keep(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        rows = out.collect()
        now = {r.doc_id for r in rows}
        assert now <= ids and len(now) == len(rows), name
        if name == "line dedup":
            assert now == ids
        if name == "near dedup":
            groups = simhash.near_duplicates(docs).groupBy("component").agg(F.min("doc_id").alias("d")).collect()
            assert now == {r.d for r in groups}
        if name == "encoding":
            assert now == ids and out.columns[0] == "doc_id"
        else:
            assert out.columns == docs.columns
            docs = spark.createDataFrame(rows, out.schema)
        ids = now
    assert len(corpus_pipeline.run(spark, SMALL).collect()) == len(ids)
