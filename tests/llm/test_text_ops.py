"""Token counts, HTML extraction, decontamination and line dedup."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pulseboard.llm import decontaminate, html_text, line_dedup, token_count

from . import data


# ------------------------------------------------------------------ tokens
@pytest.fixture(scope="module")
def tokenizer():
    return token_count.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def by_library(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_tokens_of_random_pieces(tokenizer):
    rng = random.Random(0)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ve", "'ll", "'l", "'r", "'v", "'m", "'d", "'t", "a", "é", "ß", "1", "²", "!", "...", " ",
             "　", "\x1c", "\x85", "日本", "🙂", "é", "S", "l", "<|endoftext|>", "<|endof", "अ", "​", "re", "LL", "hello"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", "'", "'r", " ", "a" * 4000, "ab1" * 2000, " " * 3000, "\n" * 700 + "x"]
    assert tokenizer.count(texts).tolist() == by_library(texts)


def test_chunks_compose(tokenizer, monkeypatch):
    texts = ["it's we're they'll " * 30 + "   \n x'", "", "a"]
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(token_count, "CHUNK", size)
        assert tokenizer.count(texts).tolist() == by_library(texts)


def test_count_tokens(spark):
    rows = data.rows(30)
    df = data.clashing(data.frame(spark, rows))
    out = token_count.count_tokens(df, public_tokenizers.path("byte_bpe_50k.json"))
    assert {"lang", "size", "n_tokens"} <= set(out.columns)
    want = Counter((r[0], len((r[1] or "").encode()), n, n > 1024) for r, n in zip(rows, by_library([r[1] or "" for r in rows])))
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()) == want
    assert token_count.count_tokens(data.frame(spark, []), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# ------------------------------------------------------------------ html
PAGES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<div><p>a<p>b</div>", "a\nb"),
    ("<nav>x</nav><main><h1>T</h1><div class='share-links'>s</div><p>One <b>two</b><br>three</p><aside>no</aside><ul><li>l1<li>l2</ul>"
     "<section class=comments><p>bad comment</p></section></main><footer>f</footer>", "T\nOne two three\nl1\nl2"),
    ("<html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body><article><h1>Head &lt;1&gt;</h1><p><b>bold<br>"
     "<p>rest&nbsp;of\n it</p></article><div class=ad>buy</div></body></html>", "Head <1>\nbold\nrest of it"),
    ("</p></div><p>z</i></p><script>if(a<b){}</script>", "z"),
    ("<body><header>h</header><form><p>name</p></form><p>only text</p><div id='cookie-banner'>ok?</div>", "only text"),
    ("<article><p>" + "long " * 5000 + "</p><p>x</p>", ("long " * 5000).strip() + "\nx"), ("<p>cut off <b", "cut off"), ("<!-- only a comment -->", ""),
]


def test_html(spark):
    df = spark.createDataFrame([(k % 4 or None, "u", h, "x") for k, (h, _) in enumerate(PAGES * 2)], "page_id long, url string, html string, text string")
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert Counter((r.text, r.n_chars) for r in got.collect()) == Counter((t, len(t)) for _, t in PAGES * 2)
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_density_without_markup_hints():
    page = "<body><div><a href=1>home</a> <a href=2>news</a> <a href=3>more</a></div><div><p>" + "a real sentence of text " * 9 + "</p><p>short</p><p>" + "and more text here " * 9 + "</p></div>"
    text = html_text.main_text(page)
    assert text.startswith("a real") and "\nshort\n" in text and "home" not in text


def test_html_marks_are_evidence():
    prose = [f"Paragraph {k} of the text, long enough to be read as such. " * 4 for k in range(4)]
    body, want = "".join(f"<p>{p}</p>" for p in prose), "\n".join(p.strip() for p in prose)
    menu = "<nav><a href=1>home</a> <a href=2>news</a></nav>"
    for name in ("layout has-sidebar", "no-sidebar", "header-fixed", "with-menu", "sidebar", "content-sidebar-wrap"):
        assert html_text.main_text(f"<body>{menu}<div class='{name}'>{body}</div><footer>f</footer>") == want
    assert html_text.main_text(f"<body><form action=x><input type=hidden>{menu}<div>{body}</div><footer>f</footer></form>") == want
    assert html_text.main_text(f"<body><form>{menu}<div id=main class=no-sidebar>{body}<div class=comments><p>{prose[0]}</p></div></div></form>") == want
    inside = "<pre>x = 1 <span class='comment'># one</span></pre><section id='related-work'><h2>Related</h2><p>Others</p></section><p class='notice'>Note</p>"
    assert html_text.main_text(f"<article>{body}{inside}</article>") == want + "\nx = 1 # one\nRelated\nOthers\nNote"
    said = f"<article class='comment'><p>{prose[0] * 9}</p></article>"
    for page in (f"<article>{body}{said}</article>", f"<article>{body}</article>{said}", f"<main>{body}<div class='related-posts'><p>{prose[1]}</p></div></main>{said}"):
        assert html_text.main_text(page) == want
    assert html_text.main_text(f"{menu}<article><h1>T</h1></article><footer>{prose[0]}</footer>") == "T"
    assert html_text.main_text(f"<div class=cookie-consent>{body * 3}</div><article>{body}</article>") == want


@pytest.mark.parametrize("sizes", [
    [[300] * 3 + [5000] + [300] * 3, [300] * 8], [[400] * 8, [100] * 7], [[100] * 7, [400] * 8, [100] * 7], [[60] * 5, [2000] * 3, [45, 200, 60], [900] * 4]])
@pytest.mark.parametrize("wrap", ["{}", "<div>{}</div>", "<div><div>{}</div></div>"])
def test_html_sections_of_uneven_paragraphs(sizes, wrap):
    text = lambda n, k: (f"word{k} of a sentence here. " * (n // 20 + 1))[:n - 1] + "."
    sections, want = "", []
    for k, own in enumerate(sizes):
        lines = [f"Heading {k}", *(text(n, k) for n in own)]
        want += lines
        sections += f"<div><h2>{lines[0]}</h2>" + "".join(f"<p>{x}</p>" for x in lines[1:]) + "</div>"
    links = "".join(f"<li><a href={k}>Entry number {k} of a long menu</a></li>" for k in range(9))
    got = html_text.main_text(f"<body><nav>{links}</nav>{wrap.format(sections)}<footer>end</footer></body>")
    assert got == "\n".join(want)


def test_html_grows_to_prose_only():
    long = "<div>" + "<p>a real sentence of text, over and over</p>" * 2 + ("<p>" + "a real sentence of text " * 40 + "</p>") * 5 + "<p>one of the shorter sentences again</p>" * 9 + "</div>"
    menu = "<div><h3>More</h3><ul>" + "".join(f"<li><a href={k}>Entry number {k} of quite a long menu</a></li>" for k in range(9)) + "</ul></div>"
    items = "<div><h2>List</h2><ul><li>an item of the list that has no link at all</ul></div>"
    last = "<h2>Last</h2><p>A shorter closing sentence of the page.</p>"
    text = html_text.main_text(f"<body>{menu}{items}{menu}{long}{menu}{last}{menu}<div><a href=1>About</a> <a href=2>Contact</a></div></body>")
    assert "an item of the list" in text and text.startswith("List\n") and text.endswith("Last\nA shorter closing sentence of the page.")
    assert "Entry" not in text and "About" not in text


# ------------------------------------------------------------------ decontamination
def edit_infix(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_infix_distance():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 20))]
        text = [rng.randrange(5) for _ in range(rng.randrange(0, 40))]
        masks = defaultdict(int)
        for k, s in enumerate(item):
            masks[s] |= 1 << k
        assert decontaminate.infix_distance(dict(masks), len(item), text)[0] == edit_infix(item, text)


def contamination_case(seed=7, n_items=40):
    rng = random.Random(seed)
    items = [(k, data.sentence(rng, rng.randrange(5, 60), 3000)) for k in range(n_items)]
    docs, planted = [], {}
    for k in range(400):
        w = data.sentence(rng, rng.randrange(20, 300), 3000).split()
        if k % 4 == 0:
            i, text = items[rng.randrange(n_items)]
            own = text.split()
            share = (0, 0, 0.1, 0.19)[k // 4 % 4]
            for _ in range(int(share * len(own))):
                p = rng.randrange(len(own))
                own[p:p + rng.randrange(2)] = [f"new{rng.randrange(99)}"] * rng.randrange(2)
            at = rng.randrange(len(w))
            w[at:at] = own
            planted[k] = (i, share)
        docs.append((k, " ".join(w), "en", "s", 1))
    return items, docs, planted


def test_recall_against_brute_force(spark):
    items, docs, planted = contamination_case()
    want = set()
    for k, t, *_ in docs:
        w = t.split()
        for i, b in items:
            b = b.split()
            if (d := edit_infix(b, w) if set(b) & set(w) and len(set(b) & set(w)) >= 0.8 * len(set(b)) - 1 else 99) <= 0.2 * len(b):
                want.add((k, i, d))
    bench = spark.createDataFrame(items + [(900, None), (901, ""), (902, "too short")], "item_id long, text string")
    df = data.frame(spark, docs)
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminated(df, bench).collect()}
    assert got <= want and len(got) >= 0.95 * len(want)
    assert {(k, i) for k, (i, share) in planted.items() if share == 0} <= {g[:2] for g in got}
    split = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminated(df, bench, block_words=300).collect()}
    assert split <= want and len(split) >= 0.95 * len(want)
    clean = data.clashing(df)
    kept = decontaminate.decontaminate(clean, bench)
    assert kept.columns == clean.columns
    assert {r.doc_id for r in kept.collect()} == {d[0] for d in docs} - {g[0] for g in got}


def test_decontaminate_odd_rows(spark):
    bench = spark.createDataFrame([(1, data.ODD[9][:200]), (2, "Naïve, café; 日本語 🙂 five six"), (2, "naïve café 日本語 🙂 five six")], "item_id long, text string")
    rows = data.rows(20) + [(None, "xx NAÏVE café 日本語 🙂 five... six yy", "en", "s", 1)]
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(data.frame(spark, rows), bench).collect())
    assert got[None, 2] == 2 and any(i == 1 for _, i in got)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(data.frame(spark, rows), empty).count() == 0
    assert decontaminate.decontaminate(data.frame(spark, rows), empty).count() == len(rows)
    assert decontaminate.contaminated(data.frame(spark, []), bench).count() == 0


def test_items_without_spaces_and_short_items(spark):
    items = [(1, "中国的首都是哪一座城市，它有多少人口？"), (2, "日本で一番高い山は何という名前ですか。"), (3, "ประเทศไทยมีกี่จังหวัดในปัจจุบัน"),
             (4, "Donaudampfschifffahrtsgesellschaft heißt was?"), (5, "zu kurz"), (6, "one two three\u2014four \u201cfive\u201d six seven")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["前面的文字" * 9 + items[0][1] + "后面的文字" * 9, "x" + items[1][1].replace("高い", "高") + "はい", "ก" * 30 + items[2][1], "so: " + items[3][1].upper(),
             "zu kurz", "a one two three four five six seven b", "完全不同的一段文字，" * 20, "plain english words " * 30, None, ""]
    df = data.frame(spark, [(k, t, "zh", "s", 1) for k, t in enumerate(texts)])
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 6)}
    assert {r.doc_id for r in decontaminate.decontaminate(df, bench).collect()} == {6, 7, 8, 9}


def test_chunked_texts_keep_their_rows(monkeypatch):
    items, docs, planted = contamination_case()
    index = decontaminate.Index(items)
    monkeypatch.setattr(decontaminate, "CHUNK_WORDS", 500)
    got = {(docs[first + t][0], items[i][0]) for first, seqs in decontaminate._chunks(pa.array([d[1] for d in docs]), index) for t, i, *_ in index.hits(seqs)}
    assert {(k, i) for k, (i, share) in planted.items() if share == 0} <= got


# ------------------------------------------------------------------ lines
def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda x: data.lower(x.strip(data.SPACE))
    held = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    keeper = {k: max(v, key=lambda i: (i is not None, i)) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, t, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_rows():
    rng, rows = random.Random(9), data.rows(60)
    common = ["A line that many documents share, over forty characters", "é" * 39, "é" * 40, "x" * 39, "y" * 40, "  " + "Padded " * 6 + "\t"]
    for k in range(200, 260):
        lines = [data.sentence(rng, 12) for _ in range(3)] + [c.upper() if rng.random() < 0.3 else c for c in common if rng.random() < 0.4]
        rng.shuffle(lines)
        rows.append((k, "\n".join(lines), "en", "s", 1))
    rows += [(k, common[0], "en", "s", 1) for k in range(300, 400)] + [(None, common[0] + "\n" + common[4], "en", "s", 1)]
    return rows


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_line_dedup(spark, monkeypatch, batches):
    monkeypatch.setattr(line_dedup, "BATCHES", batches)
    rows = line_rows()
    df = data.clashing(data.frame(spark, rows))
    want = brute_lines(rows)
    got = line_dedup.dedup_lines(df, digest=True).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == Counter(
        (i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, _, n, d, t in want)
    if batches == 4:
        out = line_dedup.dedup_lines(df)
        assert out.columns == df.columns
        assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((i, t if was is not None else None) for i, was, _, _, t in want)
        assert line_dedup.dedup_lines(data.frame(spark, []), digest=True).count() == 0


@pytest.mark.parametrize("batches", [1, 3])
def test_line_dedup_takes_any_ids(spark, monkeypatch, batches):
    """Ids that are text, and dates; the same rows as with numbers in the same order."""
    monkeypatch.setattr(line_dedup, "BATCHES", batches)
    rows = [(k, f"a line that many of the documents share {k % 3} {'x' * 40}\nown {k}", None, None, None) for k in range(30)]
    df = data.frame(spark, rows)
    want = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.dedup_lines(df, digest=True).collect()}
    assert sum(v[1] for v in want.values()) == 27
    for id_ in ("format_string('id-%05d', doc_id)", "date_add(date'2020-01-01', cast(doc_id as int))"):
        got = line_dedup.dedup_lines(df.selectExpr(f"{id_} as doc_id", "text"), digest=True)
        other = {str(r[0]): r[1] for r in df.selectExpr(id_, "doc_id").collect()}
        assert {other[str(r.doc_id)]: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()} == want


def test_line_runs_meet_without_a_shuffle(spark, monkeypatch, capsys):
    """Runs are merged, and a batch is compared with them, bucket with bucket; a stored run is sorted within its files."""
    plans = []
    real = line_dedup.LineRuns._sorted

    def watched(self, run, label):
        capsys.readouterr()
        run.explain()
        plans.append((label, capsys.readouterr().out))
        return real(self, run, label)

    monkeypatch.setattr(line_dedup.LineRuns, "_sorted", watched)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = line_dedup.LineRuns(spark, "bigint")
        for lo in (300, 200, 100):
            keys = spark.range(lo, lo + 150).selectExpr("cast(md5(cast(id % 220 as string)) as binary) as key", "id").distinct()
            runs.add(keys)
        rows = {bytes(r.key): (r.docs, r.keeper.id) for r in runs.rows().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    want, top = {}, {}
    for lo in (300, 200, 100):
        batch = {}
        for i in range(lo, lo + 150):
            want[i % 220] = want.get(i % 220, 0) + 1
            batch[i % 220] = max(i, batch.get(i % 220, i))
        top = batch | top
    assert sorted(rows.values()) == sorted((want[k], top[k]) for k in want)
    # a batch is shuffled (its own distinct rows, then its hashes), a run never
    shuffles = [(label, text.count("Exchange hashpartitioning"), text.count("Bucketed: true")) for label, text in plans]
    alone = shuffles[0][1]
    assert shuffles == [("line_run0", alone, 0), ("line_run0", alone, 1), ("line_run1", 0, 2), ("line_run0", alone, 1)], shuffles


def test_line_dedup_lists_hold_one_text_only(spark):
    """Rows without an id do not share a list of all their lines."""
    line = "a line of the two thousand documents that have no id at all {}"
    rows = [(None if k < 400 else k, line.format(k % 200), None, None, None) for k in range(1400)]
    lists = line_dedup.drop_lists(data.frame(spark, rows)).selectExpr("size(drop) as n").collect()
    assert max(r.n for r in lists) == 1


def test_short_items_are_matched_whole(spark):
    items = ["Who wrote Hamlet?", "Paris", "日本の首都", "", "?!", None, "two words", "a", "naïve café"]
    benchmark = spark.createDataFrame([("" if k == 0 else f"i{k}", t) for k, t in enumerate(items)], "item_id string, text string")
    texts = ["He asked: who wrote HAMLET, and when?", "who wrote Hamlets", "Parisian life", "in paris.", "質問：日本の首都はどこですか。", "日本 首都",
             "two  words", "twowords", "Naïve, café", "", None]
    docs = data.frame(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(0, "", 0), (3, "i1", 0), (4, "i2", 0), (6, "i6", 0), (8, "i8", 0)}
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, benchmark).collect()) == [1, 2, 5, 7, 9, 10]


def test_long_pieces_are_not_remembered():
    import public_tokenizers

    t = token_count.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    t.count(["x" * 50_000, "日" * 20_000, "a few words"])
    assert max(map(len, t.known)) <= token_count.REMEMBERED_CHARS and "words" in " ".join(t.known)
