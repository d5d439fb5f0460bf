"""Operators that SQL cannot state, against brute force on small inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from heliogrid.llm import html, jaccard, lines, packing, privacy, quality, suffix, urls
from heliogrid.llm.common import document_key

PAIR = "doc_id bigint, text string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_suffix_dedup(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abé ") for _ in range(700)) for _ in range(5)]
    docs = [(None, None), (1, ""), (2, "x" * 199), (3, "x" * 200), (4, "x" * 201), (5, "ab" * 400), (6, base[0]), (6, base[0])]
    for i in range(7, 40):
        a, b, s = base[r.randrange(5)], base[r.randrange(5)], r.randrange(500)
        docs.append((i, "".join(r.choice("xyz") for _ in range(r.randrange(300))) + a[s : s + r.randrange(150, 260)] + b[r.randrange(400) :]))
    seen = Counter(t.encode()[i : i + 200] for _, t in docs if t for i in range(len(t.encode()) - 199))
    want = []
    for d, t in docs:
        data = (t or "").encode()
        hit = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - 199):
            hit[i : i + 200] |= seen[data[i : i + 200]] > 1
        runs = int((np.diff(np.r_[0, hit.astype(int)]) == 1).sum())
        want.append((d, len(data), int(hit.sum()), runs, hashlib.sha256(np.frombuffer(data, dtype=np.uint8)[~hit].tobytes()).hexdigest()))
    assert _rows(suffix.repeat_report(spark.createDataFrame(docs, PAIR).repartition(4))) == sorted(want, key=repr)


def test_repeats_that_begin_inside_a_character(spark):
    """A shared run starts with the second byte of a character: its first byte is left over."""
    run = "x" * 220
    docs = [(1, "aé" + run + "b"), (2, "cĩ" + run + "d"), (3, None), (4, "é kept")]
    got = {x.doc_id: x.text for x in suffix.remove_repeats(spark.createDataFrame(docs, PAIR)).collect()}
    assert "é".encode()[1:] == "ĩ".encode()[1:]
    assert got == {1: "a\ufffdb", 2: "c\ufffdd", 3: None, 4: "é kept"}
    with pytest.raises(ValueError, match="_kept"):
        suffix.remove_repeats(spark.createDataFrame([("x", 1)], "text string, _kept int"))


def test_blind_trie_sorts():
    r = random.Random(1)
    strings = [bytes(r.choice(b"ab") for _ in range(12)) for _ in range(300)]
    assert [strings[i] for i in suffix.blind_trie_order(strings)] == sorted(strings)


@pytest.mark.parametrize("letters", [1, 2, 3, 1000])
def test_multikey_quicksort(letters):
    r = np.random.default_rng(letters)
    groups = np.sort(r.integers(0, 40, 3000))
    words = r.integers(0, letters, (3000, 3)).astype(np.uint64) + np.uint64((1 << 64) - 1000)
    order, ties = suffix.multikey_quicksort(groups, words)
    keys = [(g, *w) for g, w in zip(groups.tolist(), words.tolist(), strict=True)]
    assert sorted(order.tolist()) == list(range(3000))
    assert [keys[i] for i in order] == sorted(keys)
    counts = Counter(keys)
    assert sorted(b - a for a, b in ties) == sorted(n for n in counts.values() if n > 1)
    assert all(len({keys[i] for i in order[a:b]}) == 1 for a, b in ties)
    for n in (0, 1):
        assert suffix.multikey_quicksort(groups[:n], words[:n])[0].tolist() == list(range(n))


def test_a_gram_over_many_batches(monkeypatch):
    """The rows are the same however the surroundings are cut into batches."""
    monkeypatch.setattr(suffix, "CHUNK", 20)
    r = random.Random(5)
    rows = sorted((h, i, 200, 168 * 256, suffix.PART, bytes(r.choice(b"ab") for _ in range(4)) * 84) for i, h in enumerate([1] * 9 + [2] * 150 + [3] * 3 + [4] * 60))
    names = ["h", "c", "at", "reach", "kind", "around"]
    whole = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)
    want = None
    for size in (1000, 7, 1, 40):
        parts = [whole.slice(a, size) for a in range(0, len(rows), size)]
        got = sorted(tuple(x.values()) for b in suffix._spans_of_parts(iter(parts)) for x in b.to_pylist())
        assert got and got == (want or got)
        want = got


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    r = random.Random(5)
    for _ in range(3000):
        a, b = ("".join(r.choice("ab") for _ in range(r.randrange(9))) for _ in range(2))
        assert all(lines.edit_distance_within(a, b, k) == (_distance(a, b) <= k) for k in range(4))


def test_line_dedup(spark):
    r = random.Random(7)
    base = ["".join(r.choice("abcdé ") for _ in range(r.randrange(5, 60))) for _ in range(15)]

    def changed(s):
        for _ in range(r.randrange(4)):
            i = r.randrange(len(s) + 1)
            s = r.choice([s[:i] + "x" + s[i:], s[:i] + s[i + 1 :], s[:i] + "q" + s[i + 1 :]])
        return s

    docs = [(None, None), (1, ""), (2, "\n \n"), (3, "short"), (4, "short"), (4, "short")]
    docs += [(i, "\n".join(changed(r.choice(base)) for _ in range(r.randrange(1, 7)))) for i in range(5, 90)]
    df = spark.createDataFrame(docs, PAIR).repartition(3)
    keys = {(x[0], x[1]): x[2] for x in df.select("doc_id", "text", document_key(F.col("doc_id"), F.col("text"))).collect()}
    # With 8 lines a task at a key, most keys go to several tasks.
    for close in (lines.Closeness(), lines.Closeness(busy=8), lines.Closeness(per_edit=1, busy=8), lines.Closeness(edits=3, per_edit=4), lines.Closeness(edits=0)):
        before, gone = [], set()
        for d, t in sorted(set(docs), key=lambda x: (x[0] is None, x[0] or 0, keys[x])):
            for p, line in enumerate((t or "").split("\n")):
                if line.strip():
                    if any(_distance(x, line) <= min(close.edits, min(len(x), len(line)) // close.per_edit) for x in before):
                        gone.add((d, t, p))
                    before.append(line)
        want = [(d, None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (d, t, p) not in gone)) for d, t in docs]
        assert _rows(lines.dedup_lines(df, close)) == sorted(want, key=repr)
    for taken in ("_k", "_removed", "N"):
        with pytest.raises(ValueError, match="exist already"):
            lines.dedup_lines(df.withColumn(taken, F.lit(1)), counts="n")
    with pytest.raises(ValueError, match="exist already"):
        jaccard.keep_one_each(df.withColumn("_K", F.lit(1)))


def test_lines_at_a_busy_key():
    """Rows of a busy key leave as they are, whatever the batches; the others meet."""
    r = random.Random(3)
    close = lines.Closeness(busy=10)
    words = ["".join(r.choice("abcdefgh") for _ in range(20)) for _ in range(40)]
    sketch = lines.sketches(words + [w[:-1] + "x" for w in words]).view(np.int64)
    rows = [(k * 8 + 2, h, sketch[h]) for k, n in enumerate((3, 40, 2, 10, 11, 1)) for i in range(n) for h in (i, 40 + i)]
    rows = sorted(rows + rows[::5])
    busy = {(k, h) for k, h, _ in rows if k in (10, 26, 34)}
    for size in (1, 7, 50, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[i : i + size], strict=True)], ["key", "h", "sketch"]) for i in range(0, len(rows), size)]
        out = [x for b in lines._meet(close)(iter(batches)) for x in b.to_pylist()]
        assert {(x["key"], x["u"]) for x in out if x["key"] is not None} == busy
        links = {tuple(sorted((x["u"], x["v"]))) for x in out if x["key"] is None}
        assert {(i, 40 + i) for i in range(3)} <= links and all(max(a, b) % 40 < 10 for a, b in links)


def test_packing(spark):
    texts = ["one two, three. " * n for n in (0, 1, 3, 700, 2000)] + ["DON'T <|endoftext|> é\x01 x", "Σ ΟΔΟΣ. \u2028y"] + [f"word{i} " * (i * 37 % 900) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), PAIR).repartition(3)
    rows = packing.pack(docs, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_sequence = {}, {}
    for x in rows:
        assert x.ids_crc32 == zlib.crc32(np.array(x.ids, dtype="<u4").tobytes()) and len(x.ids) == x.length
        by_doc.setdefault(x.doc_id, []).append(x)
        by_sequence.setdefault(x.sequence_id, []).append(x)
    for i, text in enumerate(texts):
        ids = [t for x in sorted(by_doc[i], key=lambda x: x.start) for t in x.ids]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 1] and by_doc[i][0].doc_tokens == len(ids)
    for pieces in by_sequence.values():
        end = 0
        for x in sorted(pieces, key=lambda x: x.offset):
            assert x.offset == end
            end += x.length
        assert end <= 2048 and end & (end - 1) == 0


def test_personal_data():
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def plain(t):
        out = [("email", m.start(), m.end()) for m in email.finditer(t)]
        out += [("ip", m.start(), m.end()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
        for m in card.finditer(t):
            d = [int(x) for x in re.sub("[^0-9]", "", m[0])][::-1]
            if 16 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d)) % 10 == 0:
                out.append(("card", m.start(), m.end()))
        return out + [("phone", m.start(), m.end()) for m in phone.finditer(t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]

    r = random.Random(1)
    for n in range(20_000):
        t = "".join(r.choice("a@..1239+- ()_%é\n" if n % 2 else "1234567890 -.+a@") for _ in range(r.randint(0, 40)))
        assert privacy.base_spans(t) == plain(t)
    assert len(privacy.base_spans("a" * 200_000 + "1" * 200_000)) == 0


def test_disclosing_terms(spark):
    docs = [(i, f"the report of {w} zanzibar goes to joe@corp.example.com today") for i, w in enumerate(["monday", "friday", "sunday", "easter"])]
    docs += [(i, "the report of today goes to nobody") for i in range(10, 60)]
    df = spark.createDataFrame(docs, PAIR)
    found = {r.term: r.action for r in privacy.disclosing_terms(df, thresholds=privacy.Thresholds(bits=2.0)).collect()}
    assert found == {"zanzibar": "remove"}
    clean = {r.doc_id: r.text for r in privacy.sanitise(df, thresholds=privacy.Thresholds(bits=2.0)).collect()}
    assert clean[0] == "the report of monday  goes to [email] today" and clean[10] == docs[4][1]


def test_identifiers_of_one_or_two_texts_disclose(spark):
    """One text is enough where few pairs are tested among many documents; otherwise a second one is needed."""
    few = spark.createDataFrame([(0, "zanzibar joe@corp.example.com"), *((i, "an other text") for i in range(1, 200))], PAIR)
    assert [(r.term, r.n_te, r.action) for r in privacy.disclosing_terms(few).collect()] == [("zanzibar", 1, "remove")]
    docs = [(0, "zanzibar of joe@corp.example.com the end"), (1, "the quagga +1 (017) 555-7713 the end"), (2, "the quagga +1 (017) 555-7713 an end")]
    docs += [(i, "the end of an other text") for i in range(10, 60)]
    df = spark.createDataFrame(docs, PAIR)
    assert {(r.term, r.entity, r.n_te, r.n_t) for r in privacy.disclosing_terms(df).collect()} == {("quagga", "phone:10175557713", 2, 2)}
    spans = {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.spans] for r in privacy.with_spans(df).collect()}
    assert spans[0] == [("email", 12, 32)] and spans[1] == [("phone", 11, 28), ("remove", 4, 10)] and not spans[10]
    for taken in ("_h", "_ACTIONS", "_base", "spans"):
        with pytest.raises(ValueError, match="exist already"):
            privacy.with_spans(df.withColumn(taken, F.lit(1)))


def test_terms_of_a_corpus(spark):
    """The whole term step on random texts: windows across lines, copies, terms of one letter or with digits."""
    r = random.Random(11)
    common, rare = [f"w{i}" for i in range(30)], ["q", "X7", "zanzibar", "é", "4471"]
    docs = [(None, None), (0, ""), (1, "a b@c.de"), (2, "b@c.de")]
    for i in range(3, 300):
        words = [r.choice(common) for _ in range(r.randrange(1, 40))]
        if i % 6 == 0:
            k = r.randrange(5)
            at = r.randrange(len(words) + 1)
            words[at:at] = [r.choice([rare[k], rare[k], "w1"]), f"p{k}@c.de", *r.choices([rare[k], "w1"], k=r.randrange(2))]
        docs.append((i, "".join(w + r.choice([" ", "  ", "\n"]) for w in words)))
    docs += [(300 + i, docs[r.randrange(3, 300)][1]) for i in range(20)]
    t = privacy.Thresholds(window=3, evidence=1.0)

    texts = [(d[1] or "").split() for d in docs]
    near = [{(w.lower(), "email:" + x) for at, x in enumerate(ws) if "@" in x for w in (*ws[max(0, at - 3) : at], *ws[at + 1 : at + 4])} for ws in texts]
    has = [{x.lower() for w in ws for x in re.findall(r"[^\W_]+", w)} for ws in texts]
    pairs = {x for some in near for x in some}
    want, n = set(), len(docs)
    for w, e in pairs:
        n_te, n_t = sum((w, e) in x for x in near), sum(w in x for x in has)
        n_e, support = sum(e[6:] in ws for ws in texts), len({d[1] for d, x in zip(docs, near, strict=True) if (w, e) in x})
        p, apart = n_te / n_t, n_t - n_te
        bits = math.log2(p * n / n_e)
        against = apart * (math.log2(apart / n_t) - math.log2(1 - n_e / n)) if apart else 0.0
        if p >= 0.5 and bits >= 4 and (n_te * bits + against) * support / n_te >= 1 + math.log2(len(pairs)):
            want.add((w, e, n_te, n_t, n_e, "remove" if p >= 0.8 else "generalise"))
    assert 3 <= len(want) < len(pairs) / 4
    got = privacy.disclosing_terms(spark.createDataFrame(docs, PAIR).repartition(3), thresholds=t).collect()
    assert {(x.term, x.entity, x.n_te, x.n_t, x.n_e, x.action) for x in got} == want and len(got) == len(want)


def test_wrappers_keep_their_article():
    for wrapper in ('<div class="layout has-sidebar">', '<div class="site with-header">', '<div class="row widget">', '<div id="page-menu-open">', "<form>"):
        for tag in ("article", "main"):
            page = f'{wrapper}<nav>menu</nav><div class="ad">ad</div><{tag}><p>One</p><div class="ad">ad</div><form>f</form><p>two</{tag}>'
            assert html.blocks(page) == (["One", "two"], True)
    assert html.blocks("<form><p>One</p><nav>menu</nav></form>") == (["One"], False)
    assert html.blocks('<article>One</article><div class="comments"><article>c</article></div><p>out</p>') == (["One"], True)
    assert html.blocks('<p>One <span class="ad">ad</span>two</p><div class="related"></div>') == (["One two"], False)


def test_html(spark):
    page = '<nav>menu</nav><article><h1>Title</h1><p>One &amp;\n two<p>three<form>f</form><div class="comments">c</div><script>var a="</p>"</script></article><footer>x</footer>'
    assert html.blocks(page) == (["Title", "One & two", "three"], True)
    shared = "<div>Welcome to our site please log in here now to read more</div><p>{}</p><div>Copyright by us all rights reserved please ask before you copy</div>"
    pages = [(i, f"http://h.com/{i}", shared.format(" ".join(f"w{i}x{k}" for k in range(20)))) for i in range(6)] + [(9, None, None)]
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(pages, "page_id int, url string, html string")).collect()}
    assert got == {i: " ".join(f"w{i}x{k}" for k in range(20)) for i in range(6)} | {9: ""}


def test_html_repeats_of_a_large_host(spark):
    own = {i: " ".join(f"w{i}x{k}" for k in range(20)) for i in range(1200)}
    notice = "<div>Two pages far apart share this line of twelve words or so</div>"
    pages = [(i, f"http://h.com/{i}", f"<p>{own[i]}</p>{notice if i in (3, 1100) else ''}<div>Read more here</div><p>only {i}</p>") for i in own]
    pages += [(2000, "http://h.com/a", pages[5][2]), (2001, "http://other.com/a", notice)]
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(pages, "page_id int, url string, html string")).collect()}
    assert got == {i: f"{own[i]}\n\nonly {i}" for i in own} | {2000: f"{own[5]}\n\nonly 5", 2001: notice[5:-6]}


def brute_host_step(pages):
    """Texts by counting every run of eight tokens of every host. pages: (id, host, html)."""
    found = {i: html.find(page or "") for i, _, page in pages}
    runs = lambda words: {tuple(words[k : k + 8]) for k in range(len(words) - 7)}
    words = lambda texts: [w for t in texts for w in t.split()]
    on, short = {}, {}
    for i, host, _ in pages:
        f = found[i]
        page = (tuple(f.blocks), tuple(f.outside))
        for run in runs(words(f.outside)) | (set() if f.marked else runs(words(f.blocks))):
            on.setdefault((host, run), []).append(page)
        for t in set() if f.marked else set(f.blocks):
            if len(t.split()) < 8:
                short.setdefault((host, t), set()).add(page)
    size = Counter(host for _, host, _ in pages)
    out = {}
    for i, host, _ in pages:
        f, stream, kept = found[i], words(found[i].blocks), []
        hit = [False] * len(stream)
        for k in range(len(stream) - 7):
            where = on.get((host, tuple(stream[k : k + 8])), [])
            if len(set(where)) > 1 and (not f.marked or len(where) > size[host] / 2):
                hit[k : k + 8] = [True] * 8
        at = 0
        for text, fixed in zip(f.blocks, f.fixed, strict=True):
            n = len(text.split())
            share = sum(hit[at : at + n]) / n
            at += n
            if not f.marked and n < 8 and n * len(short[host, text]) >= 16:
                share = 1
            if fixed or (share < 1 if f.marked else share <= 0.5):
                kept.append(text)
        out[i] = "\n\n".join(kept)
    return out


def test_html_host_step(spark, monkeypatch):
    """Notices of a site, inside and outside of articles, unmarked pages, quotations, copies, headings and repeated rows."""
    r = random.Random(11)
    notices = [" ".join(f"n{k}w{j}" for j in range(r.randrange(3, 15))) for k in range(6)]
    quotes = [" ".join(f"q{k}w{j}" for j in range(r.randrange(8, 15))) for k in range(4)]
    pages = [(0, "h0.com", None), (1, "h0.com", "<p>only"), (2, None, "<p>no url</p>")]
    for i in range(3, 150):
        host = f"h{r.choice([0, 0, 0, 1, 2])}.com"
        own = [" ".join(f"w{i}x{j}x{k}" for k in range(r.randrange(1, 20))) for j in range(r.randrange(1, 4))]
        body = own + r.sample(quotes, r.randrange(3)) + r.sample(notices, r.randrange(3))
        r.shuffle(body)
        inner = "".join(f"<h2>{t}</h2>" if r.random() < 0.2 else f"<p>{t}</p>" for t in body)
        outer = "".join(f"<{tag}>{r.choice(notices + quotes)}</{tag}>" for tag in r.choices(["nav", "footer", "aside"], k=2)) + f"<footer>{notices[0]} {notices[1]}</footer>"
        pages.append((i, host, f"{outer}<article>{inner}</article>" if r.random() < 0.7 else inner + outer))
    pages += [(200, *pages[9][1:]), (201, *pages[9][1:]), (202, *pages[30][1:])]
    df = spark.createDataFrame([(i, h and f"http://{h}/{i}", page) for i, h, page in pages], "page_id int, url string, html string").repartition(3)
    want = brute_host_step(pages)
    assert sum(t != "\n\n".join(html.blocks(page or "")[0]) for (_, _, page), t in zip(pages, want.values(), strict=True)) > 30
    assert {x.page_id: x.text for x in html.extract_text(df).collect()} == want
    monkeypatch.setattr(html, "may_broadcast", lambda size: False)
    assert {x.page_id: x.text for x in html.extract_text(df).collect()} == want


def test_html_broken_and_very_long_pages():
    assert html.blocks("<b>" * 60_000 + "x" + "</i>" * 60_000) == (["x"], False)
    assert html.blocks("<p><table><tr><td>" + "<b>" * 30_000 + "<div>x</div>" * 30_000) == (["x"] * 30_000, False)
    assert html.blocks("<article><p>" + "word " * 400_000) == ([("word " * 400_000).strip()], True)


def test_html_refuses_clashing_columns(spark):
    with pytest.raises(ValueError, match="_host"):
        html.extract_text(spark.createDataFrame([(1, "u", "h", 1)], "page_id int, url string, html string, _host int"))


def test_url_rules_by_index_and_join(spark):
    rules = [urls.host_rule("com/", "allow"), urls.host_rule("b.com/x", "block"), urls.UrlRule("any-login", "block", r".*login", ())]
    pages = spark.createDataFrame([(1, "http://a.b.COM/xy?q"), (2, "http://bb.com/"), (3, None), (4, "x://c.org/login"), (5, "http://com")], "page_id int, url string")
    want = [(1, "b.com/x", "block"), (2, "com/", "allow"), (3, None, "allow"), (4, "any-login", "block"), (5, None, "allow")]
    for by_join in (False, True):
        assert _rows(urls.filter_urls(pages, rules, by_join=by_join).select("page_id", "rule", "verdict")) == want


def test_busy_shingles_take_the_same_links(spark, monkeypatch):
    r = random.Random(2)
    base = [[r.choice("abcdefghij") * 3 + str(r.randrange(50)) for _ in range(60)] for _ in range(4)]
    docs = []
    for i in range(120):
        words = list(base[i % 4])
        for _ in range(r.randrange(4)):
            words[r.randrange(60)] = f"n{i}"
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, PAIR)
    sim = jaccard.Similarity(4, 85)
    sets = [set(jaccard.shingles(t.encode(), 4).tolist()) for _, t in docs]
    label = list(range(len(docs)))
    for _ in docs:
        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    want = sorted(zip(range(len(docs)), label, strict=True))
    assert sorted((x.doc_id, x.component_id) for x in jaccard.near_duplicates(df, sim).collect()) == want
    for name, value in (("FEW", 2), ("MANY", 8), ("BLOCK_TOKENS", 1000)):
        monkeypatch.setattr(jaccard, name, value)
    assert sorted((x.doc_id, x.component_id) for x in jaccard.near_duplicates(df, sim).collect()) == want


def test_ablation(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "word " * 60), (3, " ".join(f"w{i}" for i in range(60)))], PAIR)
    ledger = quality.with_ledger(docs)
    got = {(r.rule): (r.n_failed, r.n_only) for r in quality.ablation(ledger, (quality.BASE,)).collect()}
    assert got == {"few_words": (1, 1), "repeated_windows": (1, 1)}
    assert [r.doc_id for r in ledger.filter(quality.passes(quality.STANDARD)).collect()] == [3]
