import random
import re

import numpy as np
import pytest

from fieldloom.llm import boilerplate, leaks, lines, mixing, naming, splitting, stuffing

TOKENIZER = mixing.TOKENIZER


# --- oversized texts


def check_pieces(text, limits):
    pieces = splitting.cut(text, limits)
    back, last = "", 0
    for i, (a, b) in enumerate(pieces):
        assert 0 < b - a <= limits.limit and a <= last < b and last - a <= limits.overlap
        back += text[last:b]
        last = b
    assert back == text
    return pieces


@pytest.mark.parametrize("seed", range(6))
def test_pieces_rebuild_the_text(seed):
    rng = random.Random(seed)
    limits = splitting.PieceLimits(limit=rng.choice([20, 60, 200]), overlap=rng.choice([0, 5, 15]))
    for _ in range(60):
        text = "".join(rng.choice(["word", "ab", " ", "  ", "\n", "\n\n", ". ", "é", "x" * 30, "? ", "\r\n", "中文"]) for _ in range(rng.randrange(80)))
        if text:
            check_pieces(text, limits)


def test_natural_boundaries():
    limits = splitting.PieceLimits(limit=60, overlap=10)
    text = "First sentence here. Second sentence goes on.\n\nA new paragraph starts here and goes on for long."
    a, b = check_pieces(text, limits)[0]
    assert text[a:b].endswith("\n\n")
    assert [b - a for a, b in check_pieces("x" * 150, limits)] == [60, 60, 50]
    assert splitting.cut("") == [] and splitting.cut("ab") == [(0, 2)]
    with pytest.raises(ValueError):
        splitting.PieceLimits(10, 10)


def test_split_rows(spark):
    long = "word " * 900
    df = spark.createDataFrame([(1, long, 5), (2, "short", 5), (3, None, 5), (4, "", 5), (None, long, 5)], "text_id bigint, clean_text string, piece_no int")
    got = splitting.split_oversized(df, "text_id", "clean_text").collect()
    assert {r.text_id for r in got} == {1, None} and all(len(r.piece) <= 2000 for r in got)
    assert "".join(r.piece[r.overlap :] for r in sorted((r for r in got if r.text_id == 1), key=lambda r: r.piece_no)) == long
    assert splitting.split_oversized(df, "text_id", "clean_text", only_oversized=False).filter("text_id = 2").count() == 1
    assert splitting.split_oversized(df.limit(0), "text_id", "clean_text").count() == 0


# --- boilerplate


PAGE = """We use cookies to improve your visit.
Home
Sport
Health

Grain arrives in Testville
TESTVILLE (The Post) - Traders say that prices fell by a third in a week, the first drop since March.
"Nobody came to buy."
Background
The road to the south has been closed since Monday, and stocks are low in the villages beyond it.
- Testville: 30 kg maize
Read also: Locusts cut off Oldtown
Most read
1. Floods cut off Newtown
Copyright 2020 The Post Media Group"""


def test_story_of_a_page(spark):
    df = spark.createDataFrame([(1, PAGE, "Grain arrives in Testville", "https://thepost.example/1", 0), (2, "Error", "x", "u", 0), (3, None, None, None, 0), (4, " \n ", None, None, 0)], "article_id bigint, clean_text string, header string, sourceurl string, line_no int")
    got = {r.line_no for r in boilerplate.find_boilerplate(df).filter("around").collect()}
    assert got == {1, 2, 3, 4, 12, 13, 14, 15}
    story = {r.article_id: r.story for r in boilerplate.story_text(df).collect()}
    assert story[1].startswith("Grain arrives") and story[2] is None and story[3] is None and story[4] is None
    assert boilerplate.find_boilerplate(df.limit(0)).count() == 0


def test_tree_on_held_out_pages():
    pages = boilerplate.labelled_pages()
    assert sum(len(x[2]) for x in pages) <= boilerplate.MAX_BLOCKS
    for side in (0, 1):
        tree = boilerplate.fitted(pages[side::2])
        same = np.concatenate([(tree.predict(boilerplate.describe(lines_, t, u)[1]) > 0.5) == (y == 1) for t, u, lines_, y in pages[1 - side :: 2]])
        assert same.mean() > 0.99


def test_blocks():
    at, x = boilerplate.describe(["Home | Sport | Health", "", "A long sentence without any link stands here.", "Read also: more"], None, None)
    f = lambda name: x[:, boilerplate.FEATURES.index(name)].tolist()
    assert at == [0, 2, 3] and f("links") == [3 / 5, 0.0, 1.0] and f("links_prev") == [0.0, 3 / 5, 0.0] and f("links_next") == [0.0, 1.0, 0.0] and f("around") == [0, 0, 1] and f("paragraph") == [0, 1, 0]
    assert boilerplate.describe([], "t", "u")[1].shape == (0, len(boilerplate.FEATURES)) and boilerplate.describe([" "], None, None)[0] == []
    assert boilerplate.block("x" * 100_000)[6] == 1


def test_tree_splits():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 1] > 0.2) & (x[:, 2] < 0.5)
    tree = boilerplate.DecisionTree(leaf=1).fit(x, y)
    assert ((tree.predict(x) > 0.5) == y).all() and len(boilerplate.DecisionTree().fit(x, np.ones(400)).feature) == 1


# --- names


def osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_edit_distances_and_keys():
    rng = random.Random(3)
    pairs = []
    for size in (9, 9, 9, 30, 60):
        for _ in range(250):
            a = "".join(rng.choice("abc") for _ in range(rng.randrange(size > 9 and size - 13, size)))
            b = list(a)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(b) + 1)
                b[k : k + rng.randrange(3)] = rng.choice([["c"], [], b[k : k + 2][::-1], ["a", "b"]])
            pairs.append((a, "".join(b)))
    got = naming.edit_distances([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [min(osa(a, b), 4) for a, b in pairs]
    near = 0
    for a, b in pairs:
        if a and b and osa(a, b) <= min(naming.allowed(len(a)), naming.allowed(len(b))):
            near += 1
            assert set(naming.deletions(a)) & set(naming.deletions(b)), (a, b)
    assert near > 500 and len(naming.deletions("ab" * 400)) < 100
    assert naming.edit_distances([], []).tolist() == [] and naming.similarities(["abcd", "", "ab"], ["abce", "", "ac"]).tolist() == [0.75, 1.0, 0.0]


def test_keys_bound_the_score(spark):
    """Every entry that reaches the limit for a name shares a key with it."""
    rng = random.Random(5)
    words = ["north", "south", "old", "new", "kelimot", "baruvan", "dola", "gir", "zanimor", "district", "x1", "x2", "port"]
    units = [(i, "X", rng.choice(words), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))) for i in range(60)]
    index = naming.indexed(spark.createDataFrame(units, "unit_id bigint, admin0 string, admin1 string, admin2 string")).collect()
    limits, reached = naming.Matching(), 0
    assert len(index) == 60 and sum(len(r["keys"]) for r in index) < sum(len({*r["district"], ""}) for r in index)
    for _ in range(150):
        qd = naming.tokens(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))))
        for r in index:
            entry = {k: r[k] for k in ("region", "district", "tokens", "weights", "unknown")}
            sim = {(q, e): 1.0 for q in {*qd, naming.joined(qd)} for e in r["vocabulary"] if q == e}
            if naming.entry_scores(qd, [], entry, sim, limits)[0] >= limits.accept:
                reached += 1
                assert {*qd, naming.joined(qd)} & set(r["keys"])
    assert reached > 100


def test_match_names(spark):
    units = spark.createDataFrame([(1, "X", "Baruvan", "North Kelimot"), (2, "X", "Baruvan", "South Kelimot"), (3, "X", "Dolagir", "Thôshadait"), (4, "Y", "Zanimor", "Thoshadait"), (5, "X", "Dolagir", "Wach-Esok"), (6, "X", "Baruvan", "Wach-Esok")], "unit_id bigint, admin0 string, admin1 string, admin2 string")
    cases = [
        ("X", "Baruvan", "North Kelimot", None), ("X", "baruvan", "Kelimot-North", 1), ("X", None, "S. Kelimto Dist.", 2), ("X", "Dolagir", "thoshadait?", 3), ("Y", "Zanimor", "THOSHADATI", 4),
        ("X", "Dolagir", "Dolagir / Wach Esok", 5), ("X", "Baruvan", "wachesok", 6), ("X", "Baruvan", "unknown district", 0), ("X", "Baruvan", "Zuriponder", 0), ("Q", "a", "North Kelimot", 0), (None, None, "North Kelimot", 0), ("X", "Baruvan", "", 0), ("X", "Baruvan", None, None),
    ]
    df = spark.createDataFrame([("t", i, *c[:3], "extra") for i, c in enumerate(cases)] + [("t", None, "X", "a", "b", "e"), ("t", 1, "X", "baruvan", "Kelimot-North", "e")], "src string, row_key bigint, country string, region string, district string, unit_id string")
    got = naming.match_names(df.drop("unit_id"), units)
    assert sorted((r.row_key, r.unit_id) for r in got.collect()) == [(i, c[3]) for i, c in enumerate(cases) if c[3] is not None]
    assert naming.match_names(df.drop("unit_id").limit(0), units).count() == 0
    assert {r.unit_id for r in naming.match_names(df.drop("unit_id"), units.limit(0)).collect()} == {0}


# --- recurring lines


def test_recurring_lines(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        src = rng.choice(["Hot", "hot", "b", None])
        text = "\n".join(rng.choice(["Share this  12", "SHARE THIS", "one %d" % i, "", " 7 ", "Follow us", f"line {rng.randrange(30)}x"]) for _ in range(8))
        rows.append((i * 37, src, None if rng.random() < 0.05 else text, "k"))
    rows += rows[:5]
    df = spark.createDataFrame(rows, "article_id bigint, sourcecommonname string, clean_text string, often string")
    key = lambda x: re.sub(r"[\s\d]+", "", x.lower())
    docs = {}
    for i, s, t, _ in rows:
        if s and t is not None:
            for x in t.split("\n"):
                docs.setdefault((s.lower(), key(x)), set()).add(i)
    often = {k for k, v in docs.items() if len(v) >= 10 and k[1]}
    want = {(i, n) for i, s, t, _ in rows if s and t is not None for n, x in enumerate(t.split("\n"), 1) if (s.lower(), key(x)) in often}
    for chunk in (20, lines.CHUNK_DOCUMENTS):
        got = lines.repeated_line_numbers(df, chunk=chunk)
        assert {tuple(r) for r in got.collect()} == want and want and got.count() == len(want)
    for r in lines.remove_repeated_lines(df).collect():
        if r.sourcecommonname and r.clean_text is not None:
            assert r.kept_text == "\n".join(x for x in r.clean_text.split("\n") if (r.sourcecommonname.lower(), key(x)) not in often)
        else:
            assert r.kept_text == r.clean_text
    assert lines.repeated_line_numbers(df.limit(0)).count() == 0


def test_rows_with_one_key(spark):
    rows = [(i, "s", "often\nx") for i in range(12)] + [(0, "s", "y\nOFTEN  1"), (0, None, "often\nx")]
    df = spark.createDataFrame(rows, "article_id int, sourcecommonname string, clean_text string")
    kept = [(r.sourcecommonname, r.clean_text, r.kept_text) for r in lines.remove_repeated_lines(df).filter("article_id = 0").collect()]
    assert sorted(kept, key=repr) == sorted([("s", "often\nx", ""), ("s", "y\nOFTEN  1", "y"), (None, "often\nx", "often\nx")], key=repr)


def test_bitmaps(spark):
    rng = np.random.default_rng(1)
    sizes = {}
    for n in (0, 1, 3, 50, 2000, 9000, 16384):
        numbers = np.unique(rng.integers(0, 16384, n).astype(np.uint16))
        held = lines.Bitmap(numbers)
        again = lines.Bitmap.from_bytes(held.to_bytes())
        assert (again.numbers == numbers).all() and len(again) == len(numbers) and again.contains(numbers).all()
        assert again.contains(np.arange(16384, dtype=np.uint16)).sum() == len(numbers)
        sizes[n] = len(held.to_bytes())
    assert sizes[50] <= 101 and sizes[9000] <= 2049 and len(lines.Bitmap(np.arange(16384, dtype=np.uint16)).to_bytes()) == 5
    a, b = lines.Bitmap(np.array([1, 5], np.uint16)), lines.Bitmap(np.array([2, 5], np.uint16))
    assert lines.Bitmap.union([a, b]).numbers.tolist() == [1, 2, 5]
    df = spark.createDataFrame([(i, "s", t) for i in (0, 1, 63, 64, 129, 129, 10**15) for t in ("same", "SAME 2")], "article_id bigint, sourcecommonname string, clean_text string")
    [row] = lines.line_bitmaps(df, "article_id", "sourcecommonname", "clean_text").collect()
    assert row.n == 6 and lines.Bitmap.from_bytes(bytes(row.bitmap)).numbers.tolist() == [0, 1, 2, 3, 4, 5]
    parted = lines.line_bitmaps(df, chunk=3).collect()
    assert len(parted) > 1 and sum(r.n for r in parted) == 6


# --- leaks


def test_leaks(spark):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "re", "tu", "vo") for b in ("ban", "dor", "fil", "gam", "hes", "jun", "pel")]
    items = {i: [rng.choice(vocabulary) + str(i) if rng.random() < 0.5 else rng.choice(vocabulary) for _ in range(60)] for i in range(12)}
    filler = lambda n: [f"w{rng.randrange(9999)}" for _ in range(n)]
    rows, want = [], set()
    for d in range(150):
        i, size = rng.randrange(12), rng.choice([8, 10, 16, 24, 40])
        at = rng.randrange(60 - size)
        words = list(items[i][at : at + size])
        if size >= 16:
            want.add((d, i))
            if size >= 24:
                words[size // 2] = "zzz"
        passage = " ".join(words)
        passage = rng.choice([passage, passage.upper(), "<b>" + passage.replace(" ", "</b> <b>") + "</b>", passage.replace(" ", ",\n"), "**" + passage.replace(" ", "** _") + "_"])
        rows.append((d, " ".join(filler(30)) + " «" + passage + "» " + " ".join(filler(20)), "k"))
    rows += [(900, None, "k"), (901, "", "k"), (None, rows[0][1], "k"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    its = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(99, None), (98, "too short")], "item_id bigint, text string")
    got = leaks.find_leaks(docs, its).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    text = {d: t for d, t, _ in rows}
    for r in got:
        part = leaks.words_of(text[r.doc_id][r.begin : r.end])
        assert len(part) >= 15 and part[0] in items[r.item_id] and part[-1] in items[r.item_id]
    assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, its, offsets=False, block_chars=700).collect()} == want
    assert leaks.find_leaks(docs, its.limit(0)).count() == 0 and leaks.find_leaks(docs.limit(0), its).count() == 0


def test_leaks_partly_loose():
    item = [f"i{k}" for k in range(80)]
    finder = leaks.PassageFinder([(1, " ".join(item))])
    find = lambda words: list(finder.find(" ".join(["x"] * 5 + words + ["y"] * 5)))
    loose = lambda lo, hi, begin, n: [f"z{k}" if k >= begin and (k - begin) % n == 0 else item[k] for k in range(lo, hi)]
    rest = loose(0, 39, 15, 4)  # 15 words verbatim, then one in four changed
    assert finder.kept(15, 0) and not finder.kept(39, 6)
    [(key, begin, size, span, edits)] = find(rest)
    assert key == 1 and begin == 5 and size == span >= 15 and finder.kept(span, edits)
    exact_then_loose = item[:20] + [f"z{k}" if k % 4 == 0 else item[k] for k in range(20, 50)]
    assert find(exact_then_loose)[0][3] >= 20
    runs = item[10:14] + ["z"] + item[15:19] + ["z"] + item[20:23] + ["z"] + item[24:27]  # 17 words, runs of 4, 4, 3 and 3
    assert finder.kept(17, 3) and [x[3:] for x in find(runs)] == [(17, 3)]
    short, longer = item[50:66], [f"z{k}" if k % 3 == 2 else item[k] for k in range(41)]
    for words in (short + ["u"] * 9 + longer, longer + ["u"] * 9 + short):
        [(_, _, size, span, edits)] = find(words)
        assert (size, span, edits) == (16, 16, 0)
    two = item[20:27] + ["z1", item[28], "z2"] + item[30:36]
    [(_, begin, size, span, edits)] = find(two)
    assert (begin, size, span, edits) == (5, 16, 16, 2)
    assert not find(longer) and not find(item[:14])
    assert leaks.seed_words() == 4 and leaks.seed_words(15, 100) == 7 and leaks.seed_words(10, 2) == 1


def has_passage(doc, item, finder):
    """By dynamic programming over every begin and end: equal first and last words, least edits in between."""
    for i in range(len(item)):
        for d in range(len(doc)):
            if doc[d] != item[i]:
                continue
            row = list(range(len(doc) - d))  # edits from the first word to each place of the document
            for y in range(1, len(item) - i):
                last, row = row, [y]
                for x in range(1, len(doc) - d):
                    row.append(min(last[x - 1] + (doc[d + x] != item[i + y]), last[x] + 1, row[x - 1] + 1))
                    if doc[d + x] == item[i + y] and finder.kept(y + 1, last[x - 1]):
                        return True
    return False


@pytest.mark.parametrize("seed", range(4))
def test_leaks_against_every_alignment(seed):
    rng = random.Random(seed)
    got, want = [], []
    for case in range(40):
        item = [rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(rng.randrange(14, 40))]
        at = rng.randrange(len(item) // 2)
        words = item[at : at + rng.randrange(13, 36)]
        for _ in range(rng.randrange(7)):
            k = rng.randrange(len(words))
            kind = rng.randrange(3)
            words[k : k + (kind != 1)] = [["zz1"], ["zz2", words[k]], []][kind] if kind != 1 else ["zz2"]
        doc = ["w1", "w2"] + words + ["w3", rng.choice(item)]
        finder = leaks.PassageFinder([(1, " ".join(item))])
        found = list(finder.find(" ".join(doc)))
        got.append(bool(found))
        want.append(has_passage(doc, item, finder))
        for _, first, size, span, edits in found:
            assert finder.kept(span, edits) and first + size <= len(doc)
    assert got == want and 5 < sum(want) < 40


def test_markup_of_any_length():
    long = "<a href='" + "x" * 900 + "' \n title='y'>"
    assert leaks.words_of(f"one {long}two</a> a < b and c > d") == ["one", "two", "a", "b", "and", "c", "d"]
    assert len(leaks.word_spans(f"one {long}two</a>")) == 2


def test_fold_and_spans():
    text = "L'École <i>d'été</i> &amp; « café »\\nnew_line İstanbul co­op"
    assert leaks.words_of(text)[:5] == ["lécole", "dété", "café", "new", "line"]
    spans = leaks.word_spans(text)
    assert len(spans) == len(leaks.words_of(text)) and text[slice(*spans[1])] == "d'été"


# --- mixing


def test_token_counts():
    count = mixing.token_counter(mixing.vocabulary_of(TOKENIZER))
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["word", "D'été", " ", "  ", "\n", "12,5", "! ", "\t x", "it's"]) for _ in range(12))
        assert count(text) == len(count.encode(text))
    assert count("") == 0 and count(None) == 0


def test_rake():
    cells = {("a", "en", "x"): 100.0, ("a", "fr", "x"): 50.0, ("b", "en", "y"): 300.0, ("c", "en", "x"): 10.0}
    out = mixing.rake(cells, [("a", 0.5, 5), ("b", 0.4, 2), ("c", 0.05, 2), ("d", 0.05, 3)], total=400)
    drawn = {s: sum(w * cells[k] for k, w in out.weights.items() if k[0] == s) for s in "abc"}
    assert drawn["c"] == pytest.approx(20) and drawn["a"] / drawn["b"] == pytest.approx(1.25) and sum(drawn.values()) == pytest.approx(400)
    assert all(w <= out.repeats[k[0]] + 1e-9 for k, w in out.weights.items())
    assert mixing.rake({}, [("a", 1.0, 1)]).weights == {}
    lang = mixing.rake({("a", "en", "x"): 100.0, ("a", "fr", "x"): 100.0}, [("a", 1.0, 5)], total=200, lang_shares={"en": 0.8, "fr": 0.2})
    assert lang.weights["a", "en", "x"] == pytest.approx(1.6, rel=1e-3)
    small = mixing.rake({("a", "en", "x"): 1000.0, ("b", "en", "x"): 10.0}, [("a", 0.5, 1), ("b", 0.5, 3)])
    assert sum(small.goal.values()) == pytest.approx(60) and small.goal["a"] == pytest.approx(30)


def test_topics(spark):
    rng = random.Random(9)
    words = {"food": ["maize", "harvest", "rice", "meals"], "war": ["attack", "militia", "soldiers", "armed"], "rain": ["flood", "river", "storm", "water"]}
    text = lambda y: " ".join(rng.choice(words[y] if rng.random() < 0.3 else ["the", "town", "people", "said", "of", "day"]) for _ in range(40))
    rows = [(text(y), y) for y in rng.choices(list(words), k=300)]
    model = mixing.TopicModel.fit(spark.createDataFrame(rows[:200] + [(None, "food"), ("x", None), ("", "war")], "t string, y string"), "t", "y")
    assert model.labels == ["food", "rain", "war"] and np.mean([model(t) == y for t, y in rows[200:]]) > 0.95
    assert model(None) == model("12 --") == "none" and mixing.TopicModel.fit(spark.createDataFrame([], "t string, y string"), "t", "y") is None
    with pytest.raises(ValueError):
        mixing.TopicModel.fit(spark.createDataFrame([("a", str(i)) for i in range(mixing.MOST_TOPICS + 1)], "t string, y string"), "t", "y")
    docs = spark.createDataFrame([(i, t, "s", "en", y) for i, (t, y) in enumerate(rows)], "doc_id int, text string, source string, lang string, kind string")
    target = spark.createDataFrame([("s", 1.0, 2)], "source string, target_share double, max_repeats int")
    for topic in (model, "kind"):
        margins = mixing.mix(docs, target, total_tokens=6000, topic=topic, topic_shares={"food": 0.6, "war": 0.2, "rain": 0.2})[2].collect()
        assert {r.value for r in margins if r.axis == "topic"} == {"food", "war", "rain"} and all(abs(r.share_reached - r.target_share) < 0.06 for r in margins)


def test_mix(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("maize price" for _ in range(rng.randrange(5, 60))), rng.choice(["Big", "big", "small ", "other", None]), rng.choice(["en", "fr", None]), 1) for i in range(900)]
    rows += [(5000, None, "big", "en", 1), (5001, "", "big", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, copies int")
    targets = spark.createDataFrame([("big", 0.5, 3), ("small", 0.3, 2), ("none", 0.2, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    drawn, report, margins = mixing.mix(docs, targets)
    got = drawn.collect()
    by = {(r.axis, r.value): r for r in margins.collect()}
    assert set(by) == {("lang", "en"), ("lang", "fr"), ("lang", "unknown"), ("topic", "all")} and sum(r.share_reached for k, r in by.items() if k[0] == "lang") == pytest.approx(1)
    assert all(abs(r.target_share - r.share_reached) < 0.03 for r in by.values())
    assert all(r.copies <= {"big": 3, "small": 2}[r.source] for r in got) and len({r.doc_id for r in got}) == len(got)
    shares = {r.source: r for r in report.collect()}
    assert set(shares) == {"big", "small", "none"} and not shares["none"].reachable and shares["none"].share_reached == 0
    assert shares["big"].share_reached == pytest.approx(0.625, abs=0.01) and shares["small"].share_reached == pytest.approx(0.375, abs=0.01)
    total = sum(r.tokens * r.copies for r in got)
    assert shares["big"].tokens_drawn == sum(r.tokens * r.copies for r in got if r.source == "big") and shares["big"].share_reached == pytest.approx(shares["big"].tokens_drawn / total, abs=1e-6)
    assert mixing.mix(docs.limit(0), targets)[0].count() == 0 and mixing.mix(docs, targets.limit(0))[1].count() == 0


# --- stuffed pages


PROSE = "The traders in the town said that the price of maize had gone up again, and that they were not sure when the next convoy would come. "


def test_stuffed(spark):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("gra", "mil", "sor", "tef", "yam") for b in ("den", "kor", "lim", "pos", "rut", "vas")]
    prose = lambda n: " ".join(f"In {rng.choice(words).title()}, {rng.randrange(900)} people of the {rng.choice(words)} were {rng.choice(['moved', 'helped', 'met', 'seen'])} by {rng.choice(words)} on a {rng.choice(['Monday', 'Friday'])}." for _ in range(n))
    rows = [(i, prose(8), False) for i in range(60)]
    rows += [
        (100, "Tags: " + ", ".join(rng.choice(["water pump", "maize seed", "cheap loan", "grain prices"]) for _ in range(60)), True),
        (101, "\n".join(f"[{rng.choice(words)} in {rng.choice(words)}](https://{rng.choice(words)}.example/{i})" for i in range(30)), True),
        (102, "\n".join(rng.choice(["water pump", "best water pump"]) for _ in range(60)), True),
        (103, " ".join("Looking for water pump? Find water pump here. The best water pump is our water pump." for _ in range(12)), True),
        (104, prose(6) + "\nSources:\n[1] https://a.example/1\n[2] https://b.example/2", False),
        (105, prose(6) + "\n" + "\n".join(f"{w.title()} (kg): {rng.randrange(90)} -> {rng.randrange(90)}" for w in words[:12]), False),
        (106, None, False), (107, "", False), (108, "12 34", False), (109, PROSE, False), (100, "Tags: " + ", ".join(["water pump"] * 60), True),
    ]
    df = spark.createDataFrame([(i, t, "k") for i, t, _ in rows], "doc_id bigint, text string, lang string")
    got = {r.doc_id for r in stuffing.find_stuffed(df).filter("stuffed").collect()}
    assert got == {i for i, _, s in rows if s}
    assert stuffing.find_stuffed(df.limit(0)).count() == 0


def test_stuffed_without_function_words(spark):
    prose = [(i, PROSE + f"On day {i} the road to town{i} was closed and the drivers of the lorries had to wait at the river until it was safe.") for i in range(60)]
    heaps = [(100 + i, " ".join(f"tractor spare parts item{i % 7} pump{i}" for _ in range(12))) for i in range(40)]
    df = spark.createDataFrame(prose + heaps, "doc_id bigint, text string")
    assert {r.doc_id for r in stuffing.find_stuffed(df).filter("stuffed").collect()} == {i for i, _ in heaps}


def test_stuffed_in_other_languages(spark):
    prose = [(i, PROSE + f"On day {i} the road to town{i} was closed and the drivers of the lorries had to wait at the river until it was safe.") for i in range(60)]
    others = [
        (200, "Die Händler in der Stadt sagten, dass der Preis für Mais wieder gestiegen sei und dass sie nicht wüssten, wann der nächste Transport kommt. Die Straße nach Süden ist seit Montag gesperrt, und die Vorräte in den Dörfern werden knapp."),
        (201, "Wafanyabiashara wa mji huo walisema kuwa bei ya mahindi imepanda tena na kwamba hawajui ni lini msafara ujao utafika. Barabara ya kusini imefungwa tangu Jumatatu na akiba ya vijiji imepungua kwa kiasi kikubwa, kwa mujibu wa wakulima wa eneo hilo."),
        (202, "قال التجار في المدينة إن سعر الذرة ارتفع من جديد وإنهم لا يعرفون متى تصل القافلة التالية إلى السوق بعد إغلاق الطريق"),
        (203, "ผู้ค้า ใน เมือง กล่าว ว่า ราคา ข้าวโพด เพิ่ม ขึ้น อีก และ ไม่ ทราบ ว่า ขบวน ถัดไป จะ มา เมื่อไร ราคา ข้าวโพด ใน เมือง เพิ่ม ขึ้น อีก ราคา ข้าวโพด ใน เมือง"),
    ]
    heaps = [(300, "Mais kaufen, Mais billig, Mais Preise, Mais Angebot, " * 8), (301, "mahindi bei nafuu " * 30)]
    df = spark.createDataFrame(prose + others + heaps, "doc_id bigint, text string")
    assert {r.doc_id for r in stuffing.find_stuffed(df).filter("stuffed").collect()} == {300, 301}
    assert stuffing.measure(others[0][1])[0] == "de" and stuffing.measure(others[1][1])[0] == "sw" and stuffing.measure(others[3][1])[0] == stuffing.OTHER_SCRIPT


def test_links_in_long_items():
    one = " ".join(["word"] * 400) + " see www.example.org/a"
    assert stuffing.measure(one)[6] == pytest.approx(15 / 402, abs=1e-6)
    assert stuffing.measure(" ".join(f"buy here www.shop{i}.example" for i in range(200)))[6] == 1.0
