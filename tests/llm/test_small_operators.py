"""The operators on hand-made rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import decontaminate, html_text, language, licences, personal_data, quality, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id LONG, text STRING, kept STRING, size STRING, spans STRING, `a b` INT"


def docs_of(spark, texts):
    """Documents with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "k", "s", "x", 1) for i, t in enumerate(texts)], DOCS)


def prose(n, seed=1):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(n))


# op1 -------------------------------------------------------------------------------------------

PAGE = """<html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<ul class="main-menu"><li>Home<li>About</ul><div class="cookie-notice">We use cookies</div>
<div id="content"><article><header><h1>T &amp; t</h1></header><p>One<br>two <b>three&nbsp;four<p>Five
<span class="ad-box">buy</span> six<form><input name=q>Search</form>
<table><tr><td>a<td>b<tr><td>c</table><script>var t="<p>x</p>"</script></article></div>
<aside>rel</aside><section class="comments"><p>nice</section><footer>f</footer></body></html>"""


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), (PAGE, "T & t\nOne two three four\nFive six\na\nb\nc"),
    ("<p>cut &amp <b", "cut &"), ("<article><p>a</p><!-- <p>no</p> --><p>b<footer>x</footer></article>", "a\nb"),
    ("<main><p>kept</main><p>outside", "kept"), ("<p hidden>no</p><p style='display: none'>no<p>yes", "yes"),
    ("<div>" * 3000 + "deep", "deep"), ("<p title='a>b'>q</p>", "q"), ("<nav><p>only menu</nav>", "")])
def test_text_of_a_page(page, text):
    assert html_text.main_text(page) == text


BODY = "<p>The body of the page, long enough to be most of it.</p>"


@pytest.mark.parametrize("page, text", [
    *((f"<div class=menu>Home</div>{start}{BODY}</{end}><div class='sidebar'>side</div>", BODY[3:-4]) for start, end in (
        ("<article class='post has-sidebar'>", "article"), ("<main class='no-sidebar'>", "main"),
        ("<article class='comments-open'>", "article"), ("<div class='elementor-widget'>", "div"),
        ("<div id='search-results'>", "div"), ("<article class='promo'>", "article"), ("<main id='comments'>", "main"))),
    (f"<div class='widget'><p>x<article>{BODY}</article></div>", BODY[3:-4]),
    (f"<div class='x'>{BODY}</div><div class='related'><article>card</article></div>", BODY[3:-4]),
    (f"<article>short</article><div class='comments'><article>{BODY}</article></div>", "short"),
    (f"<main><p>short<div class='comments'>{BODY * 3}</div></main>", "short"),
    ("<div class='sidebar'><p>one</p></div><p class='ad'>two", "one\ntwo"), ("<b class='ad'>all there is</b>", "all there is")])
def test_marks_by_class_do_not_lose_the_body(page, text):
    assert html_text.main_text(page) == text


def _tree(rnd, depth=0):
    label = rnd.choice("abc")
    kids = [_tree(rnd, depth + 1) for _ in range(rnd.randrange(0, 4 - depth))]
    node = html_text.Node(label)
    node.children = kids
    return node


def _brute_match(a, b):
    """All order-preserving matchings of the children, tried one by one."""
    if a.label != b.label:
        return 0
    best, p, q = 0, a.children, b.children
    for n in range(min(len(p), len(q)) + 1):
        for left in itertools.combinations(range(len(p)), n):
            for right in itertools.combinations(range(len(q)), n):
                best = max(best, sum(_brute_match(p[i], q[j]) for i, j in zip(left, right)))
    return 1 + best


def test_simple_tree_matching_is_optimal():
    rnd = random.Random(5)
    for _ in range(150):
        a, b = _tree(rnd), _tree(rnd)
        html_text._measure(a), html_text._measure(b)
        assert html_text.matched(a, b) == _brute_match(a, b)


def test_constant_texts_of_a_host_are_template(spark):
    def page(i):
        return f"<body><div class=x><p>Welcome to our site</p></div><p>{prose(9, i)}</p><p>{prose(5, 900 + i)}</p><p>All rights</p></body>"
    rows = [(i, "http://h.example/p%d" % i, page(i), "u") for i in range(12)]
    rows += [(100, "http://other.example/", page(100), "u"), (101, None, page(101), "u"), (102, "no url", None, "u"), (103, "http://h.example/", "", "u")]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, host STRING")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for i in range(12):
        assert got[i] == f"{prose(9, i)}\n{prose(5, 900 + i)}"
    for i in (100, 101):  # no wrapper can be induced
        assert got[i] == f"Welcome to our site\n{prose(9, i)}\n{prose(5, 900 + i)}\nAll rights"
    assert got[102] == got[103] == ""
    assert html_text.extract(pages.limit(0)).collect() == []


# op2 -------------------------------------------------------------------------------------------

def _brute_measures(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


TEXTS = [None, "", " \n\t", "a", "é ü b\x1cc\x85", "a b c a b c a b c", "x y z x y\nx y\nx y\n\nx y", "## $$ a", prose(60),
         prose(60) + "\n" + prose(60), "AB CD " * 40, "# " + prose(70), "$$$ " * 60, prose(3000, 4), "\x00 a\x0bb", "1 2 3 " * 30]


def test_quality_measures_and_verdicts(spark):
    got = quality.judge(docs_of(spark, TEXTS)).orderBy("doc_id").collect()
    for row, text in zip(got, TEXTS):
        want = _brute_measures(text)
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want, text
        assert row["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row["base_failed"] and row["kept"])
    assert [r["doc_id"] for r in got if r["kept"]] == [8, 11, 13]
    kept = quality.keep_good(docs_of(spark, TEXTS))
    assert kept.columns == docs_of(spark, TEXTS).columns and sorted(r["doc_id"] for r in kept.collect()) == [8, 11, 13]
    assert quality.judge(docs_of(spark, TEXTS).limit(0)).count() == 0


def test_cascade_runs_the_best_bargain_first_and_stops():
    ran = []
    rules = [quality.Rule(n, lambda t, n=n: ran.append(n) or n == "b") for n in "abc"]
    order = quality.cascade_order({"a": (1.0, 0.1), "b": (0.1, 0.05), "c": (2.0, 0.0)}, rules)
    assert [r.name for r in order] == ["b", "a", "c"]
    assert quality.first_failure(quality.Text(b"x"), order) == "b" and ran == ["b"]
    for some in itertools.permutations(quality.MORE):
        assert quality.first_failure(quality.Text(prose(80).encode()), some) is None


# op3 -------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and personal_data.passes_luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], personal_data.KINDS.index(s[2])))


def test_base_spans_are_those_of_the_patterns():
    rnd = random.Random(2)
    alphabets = ("0123456789.. -+()a@%b.", "0123456789 -", "12.", "a@.b-", "+1 ()23.-4", "é@a.b 4")
    for n in range(12_000):
        text = "".join(rnd.choice(alphabets[n % len(alphabets)]) for _ in range(rnd.randrange(50)))
        base = [s for s in personal_data.spans(text.encode()) if s[2] in personal_data.BASE_KINDS]
        assert base == _brute_spans(text), text
    long = "9" * 200_000 + " a@" + "b" * 100_000 + "." * 50_000 + "1." * 50_000
    base = [s for s in personal_data.spans(long.encode()) if s[2] in personal_data.BASE_KINDS]
    assert len(base) == 12_500


@pytest.mark.parametrize("text, found", [
    ("see https://me:pw@h.example/x", "me:pw"), ("IBAN: DE89 3704 0044 0532 0130 00 AND", "DE89 3704 0044 0532 0130 00"),
    ("iban DE88370400440532013000", None), ("SSN 078-05-1120", "078-05-1120"), ("Account no. 12345678", "12345678"),
    ('token = "24be64439e3e49cf46b2d7c9"', "24be64439e3e49cf46b2d7c9"), ("my secret = plainwordsonlyhere", None), ("on account of", None)])
def test_spans_beside_the_base(text, found):
    more = [text[s:e] for s, e, k in personal_data.spans(text.encode()) if k not in personal_data.BASE_KINDS]
    assert more == ([] if found is None else [found])


@pytest.mark.parametrize("text, found", [
    ('{"password": "24be64439e3e49cf46b2"}', "24be64439e3e49cf46b2"), ("'token': '24be64439e3e49cf46b2',", "24be64439e3e49cf46b2"),
    ('"{\\"secret\\": \\"24be64439e3e49cf46b2\\"}"', "24be64439e3e49cf46b2"), ("os['api_key'] = '24be64439e3e49cf46b2'", "24be64439e3e49cf46b2"),
    ("the password is 24be64439e3e49cf46b2", "24be64439e3e49cf46b2"), ("my account number is 12345678", "12345678"),
    ("Konto-Nr.: 12345678", "12345678"), ("IBAN (DE): DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00"),
    ('"account_number": "12345678"', "12345678"), ("SSN is 078-05-1120", "078-05-1120"), ("pay to DE89370400440532013000 now", "DE89370400440532013000"),
    ("IBAN NO93 8601 1117 947", "NO93 8601 1117 947"), ("(NL91 ABNA 0417 1643 00)", "NL91 ABNA 0417 1643 00"),
    ("pay to DE88370400440532013000 now", None), ("XDE89370400440532013000", None), ("DE893704004405320130001", None), ("in our account is nothing", None)])
def test_spans_after_looser_cues(text, found):
    more = [text[s:e] for s, e, k in personal_data.spans(text.encode()) if k not in personal_data.BASE_KINDS]
    assert more == ([] if found is None else [found])


def test_personal_data_of_rows(spark):
    texts = [None, "", "é a@b.co a@b.co", "1.2.3.4"]
    got = personal_data.find_personal_data(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r["spans"]] for r in got] == [
        [], [], [("email", 2, 8), ("email", 9, 15)], [("ip", 0, 7)]]


# op5 -------------------------------------------------------------------------------------------

def test_licences_are_read_and_inherited(spark):
    apache = "x y\nLicensed under the Apache License, Version 2.0\nz"
    rows = [(0, "a/LICENSE", "Released under the MIT License."), (1, "a/b/f.py", "code"), (2, "a/b/c/g.py", apache),
            (3, "a/b/c/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."),
            (4, "a/b/c/d/h", None), (5, "other/f", "no licence here, sorry"), (6, None, apache), (7, "LICENSE", apache),
            (8, "f", ""), (1, "a/b/f.py", "code"), (9, "a/b2/f", "We licensed it. Copyright who knows, all rights reserved by nobody")]
    files = spark.createDataFrame([(*r, "x") for r in rows], "file LONG, path STRING, text STRING, licence STRING")
    got = sorted((r["file"], r["licence"] or "", r["origin"]) for r in licences.scan(spark, files.select("file", "path", "text")).collect())
    assert got == [(0, "MIT", "own"), (1, "MIT", "inherited"), (1, "MIT", "inherited"), (2, "Apache-2.0", "own"), (3, "GPL-3.0", "own"),
                   (4, "GPL-3.0", "inherited"), (5, "", "none"), (6, "Apache-2.0", "own"), (7, "Apache-2.0", "own"),
                   (8, "", "none"), (9, "MIT", "inherited")]
    assert licences.scan(spark, files.select("file", "path", "text").limit(0)).count() == 0


def _licence_text(name):
    return (licences.TEXTS / f"{name}.txt").read_text()


def test_whole_licence_files_and_headers_tell_families_apart(spark):
    def comment(text, mark="# "):
        return "\n".join(mark + line for line in text.splitlines())

    names = ["BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "Zlib", "AGPL-3.0", "GPL-3.0", "GPL-2.0", "LGPL-2.1", "CC0-1.0", "EPL-2.0", "MIT"]
    rows = [(k, f"p{k}/LICENSE", "Copyright (c) 2020 Jane Doe\n\n" + _licence_text(n)) for k, n in enumerate(names)]
    rows += [(100 + k, f"q/{k}.py", "#!/usr/bin/python\n" + comment(_licence_text(n)) + "\nimport os\n" * 50)
             for k, n in enumerate(names[:5])]
    agpl = _licence_text("AGPL-3.0.header0").replace(" ", "\n * ", 9)
    rows += [(200, "q/a.c", f"/*\n * A program.\n * {agpl} */\nint main;\n"),
             (201, "q/readme", "Some words.\n\nThis project is licensed under the\nApache License,\nVersion 2.0\n\nMore words."),
             (202, "q/x.py", "# nothing to see here\nimport os"), (203, "p2/LICENSE-2", prose(300)), (204, None, None)]
    files = spark.createDataFrame(rows, "file LONG, path STRING, text STRING")
    got = {r["file"]: r["licence"] for r in licences.scan(spark, files).collect()}
    assert got == {**dict(enumerate(names)), **{100 + k: n for k, n in enumerate(names[:5])},
                   200: "AGPL-3.0", 201: "Apache-2.0", 202: None, 203: "ISC", 204: None}


def test_the_licence_scan_runs_no_python(spark, sf):
    from tidemark.llm.queries import QUERIES
    plan = QUERIES["op5_licence_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# op7 -------------------------------------------------------------------------------------------

def _toxic_rows(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        toxic, bad = rnd.random() < 0.2, rnd.random() < 0.2
        text = prose(60, seed * 1000 + i)
        words = text.split()
        if toxic:
            words[3:3] = [rnd.choice(["zzidiot", "zzclown", "zzscum"]) + rnd.choice(["", "er", "st"]) for _ in range(3)]
        if bad:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), int(not bad), int(toxic)))
    return rows


def test_the_chain_finds_held_out_toxic_texts(spark):
    rows, fresh = _toxic_rows(400, 1), _toxic_rows(200, 2)
    docs = spark.createDataFrame([(r[0], r[1], "x") for r in rows], "doc_id LONG, text STRING, toxic STRING")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows] + [(None, 1, 1), (3, None, 1), (9999, 0, 1)],
                                   "doc_id LONG, quality INT, toxic INT")
    model = toxicity.train(docs, labels)
    unseen = spark.createDataFrame([(r[0], r[1]) for r in fresh] + [(1000, None), (1001, ""), (1002, "12 $$")], "doc_id LONG, text STRING")
    got = {r["doc_id"]: r for r in toxicity.score(unseen, model).collect()}
    assert [got[i]["toxic"] for i in (1000, 1001, 1002)] == [False] * 3
    right = sum(got[r[0]]["toxic"] == bool(r[3]) for r in fresh)
    assert right >= 190 and not any(got[r[0]]["toxic"] and not r[3] for r in fresh)
    low, fine = ([got[r[0]]["p_low_quality"] for r in fresh if r[2] == q] for q in (0, 1))
    assert sum(a > b for a in low for b in fine) >= 0.97 * len(low) * len(fine)
    assert toxicity.train(docs, labels.limit(0)) is None
    assert [r["toxic"] for r in toxicity.score(unseen.limit(1), None).collect()] == [False]


def test_later_models_see_out_of_fold_predictions():
    """With its own labels as features a later model would lean on the earlier one fully."""
    rng = np.random.default_rng(0)
    raws = [prose(30, i).encode() for i in range(300)]
    noise = rng.random(300) < 0.5
    y = np.stack([noise, noise], axis=1)  # labels no text explains
    model = toxicity.fit_chain(raws, y, np.arange(300) % 3)
    before = model.weights[1][len(model.vocabulary) + 3]
    assert abs(before) < 5


# op9 -------------------------------------------------------------------------------------------

def _phrases(text, known):
    n = i = 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in known:
            j += 1
        i, n = max(j - 1, i + 1), n + 1
    return n


def test_cross_parsing_counts_longest_match_phrases():
    texts = (("one", language.folded(prose(200, 1))), ("two", language.folded(prose(200, 2))))
    model = language.Model(texts)
    for seed in range(20):
        text = language.folded(prose(30, 50 + seed) + " xyz ü")[:language.STRETCH]
        code = model.code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        row = np.full((1, language.STRETCH), language.PAD, np.uint8)
        row[0, :len(code)] = code
        assert model.phrases(row)[0].tolist() == [_phrases(text, known) for _, known in texts]


def _script(first, letters, n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(chr(first + rnd.randrange(letters)) for _ in range(rnd.randrange(2, 6))) for _ in range(n))


def test_all_letters_of_all_scripts_are_told_apart():
    scripts = {"ar": (0x627, 10), "el": (0x3B1, 17), "en": (0x61, 26), "ja": (0x3042, 60), "ko": (0xAC00, 400), "ru": (0x430, 32), "zh": (0x4E00, 900)}
    texts = tuple((name, language.folded(_script(*at, 2000 if name in ("en", "ru") else 400, 1))) for name, at in scripts.items())
    model = language.Model(texts)
    assert [p for p, _ in model.predict([_script(*at, 60, 2).encode() for at in scripts.values()])] == list(scripts)
    mixed = language.folded(" ".join(_script(*at, 6, 3) for at in scripts.values()) + " \u0905")[:language.STRETCH]
    row = np.full((1, language.STRETCH), language.PAD, model.code.dtype)
    row[0, :len(mixed)] = model.code[np.frombuffer(mixed.encode("utf-32-le"), np.uint32)]
    assert model.phrases(row)[0].tolist() == [_phrases(mixed, known) for _, known in texts]


def test_the_automaton_knows_all_substrings_and_no_others():
    text = "abcabxabcd"
    moves = language.automaton(text)

    def walk(word):
        state = 0
        for c in word:
            if c not in moves[state]:
                return False
            state = moves[state][c]
        return True
    for n in range(1, 5):
        for word in map("".join, itertools.product("abcdx", repeat=n)):
            assert walk(word) == (word in text)


def test_held_out_languages_are_told_apart(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = language.identify(docs, language.training_texts(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held) and all(0 <= r["score"] <= 1 for r in found)


def test_training_reads_beyond_equal_openings(spark):
    notice = "notice " * 200
    rows = [(k, notice + _script(*at, 1500, k), lang) for k in range(40) for lang, at in (("en", (0x61, 26)), ("ru", (0x430, 32)))]
    texts = language.training_texts(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING"))
    assert [name for name, _ in texts] == ["en", "ru"] and sum("\u0430" <= c <= "\u044f" for c in texts[1][1]) > len(texts[1][1]) / 2


def test_texts_without_letters_and_without_training(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "12 $$", "en"), (3, "", None), (None, "abc", None), (4, "abc abd", "en"), (6, "abd", "en")],
                                 "doc_id LONG, text STRING, lang STRING")
    texts = language.training_texts(docs)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, texts).collect()}
    assert got == {1: "und", 2: "und", 3: "und", None: "en", 4: "en", 6: "en"}
    assert language.training_texts(docs.limit(0)) == ()
    assert {r["lang_pred"] for r in language.identify(docs, ()).collect()} == {"und"}


# op10 ------------------------------------------------------------------------------------------

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _tokens(text):
    return TOKEN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute_hits(text, items):
    words, hit, found = _tokens(text), set(), set()
    for item, other in items:
        own = _tokens(other)
        n = min(10, len(own))
        windows = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(None if item is None else str(item))
    return len(words), len(hit), found


ITEMS = [(1, prose(30, 1)), (2, "Short Item"), (3, None), (4, ""), (None, prose(12, 2)), (10, prose(11, 3)), (1, prose(9, 4)), (7, "ÄÖ ü"), (8, "solo")]
TEXTS10 = [None, "", prose(30, 1), prose(30, 1).upper(), "x " + prose(12, 2) + " y " + prose(30, 1)[:120], "a short, ITEM!", "äö ü ÄÖ ü",
           prose(11, 3) * 2, prose(400, 9) + " " + prose(11, 3) + " " + prose(11, 3), "no hit", "solo solo", prose(12, 2)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_matches_of_benchmark_windows(spark, block_bytes):
    docs, bench = docs_of(spark, TEXTS10), spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id LONG, text STRING, n_hit STRING")
    got = decontaminate.find_matches(docs, bench, block_bytes=block_bytes).orderBy("doc_id").collect()
    for row, text in zip(got, TEXTS10):
        assert (row["n_words"], row["n_hit"], set(row["items"])) == _brute_hits(text, ITEMS), text
        assert sum(s["end"] - s["start"] for s in row["spans"]) == row["n_hit"]
    assert got[2]["longest_match"] == 30
    clean = decontaminate.remove_contaminated(docs, bench, block_bytes=block_bytes)
    assert sorted(r["doc_id"] for r in clean.collect()) == [r["doc_id"] for r in got if not r["n_hit"]] and clean.columns == docs.columns
    nothing = decontaminate.find_matches(docs, bench.limit(0)).collect()
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in nothing)


@pytest.mark.parametrize("least", [1, 2, 4, 10])
def test_random_texts_against_random_benchmarks(least):
    rnd = random.Random(least)
    for _ in range(40):
        items = [(k, " ".join(rnd.choice("abcd") for _ in range(rnd.randrange(least, least + 8)))) for k in range(3)]
        texts = [" ".join(rnd.choice("abcde") for _ in range(rnd.randrange(0, 60))) for _ in range(5)]
        block = decontaminate.Block([(str(k), t.encode()) for k, t in items])
        for text, (n, ranges, found, _) in zip(texts, block.scan([t.encode() for t in texts])):
            assert (n, sum(e - s for s, e in ranges), found) == _brute_hits(text, items)


def test_digest_of_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_pages_of_any_depth(spark):
    deep = [f"<html><body>{'<div>' * n}<p>Deep words of page {n} here</p>{'</div>' * n}<p>tail</p></body></html>" for n in (2000, 1900, 3)]
    pages = spark.createDataFrame([(k, f"http://h/{k}", h) for k, h in enumerate(deep)], "page_id LONG, url STRING, html STRING")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert all("Deep words of page" in got[k] for k in range(3))


def test_text_of_formulas_and_objects_stays(spark):
    pages = spark.createDataFrame([(1, "http://h/1", "<p>The area is <math><mi>x</mi></math> <object>here</object></p>")],
                                  "page_id LONG, url STRING, html STRING")
    assert html_text.extract(pages).first()["text"] == "The area is x here"


def test_a_repeated_document_is_drawn_once(spark):
    rows = [(1, "abc def ghi", "en")] * 3000 + [(k, f"text number {k}", "en") for k in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    ((name, text),) = language.training_texts(docs)
    assert name == "en" and text.count("abc def ghi") <= 1
