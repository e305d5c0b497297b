"""Near copies, lines, benchmark passages, pages, conversations and the pipeline against plain versions."""

import hashlib
import itertools
import random
import re

import numpy as np
import xxhash
from brute import BASE, TEXTS, frame, lower, union, words
from pyspark.sql import functions as F

from millrace.llm import chat, components, decontaminate, lines, pages, simhash


def test_components(spark):
    rng = random.Random(1)
    pairs = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)]
    pairs += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)] + [(5, 5), (7, 6)]
    df = spark.createDataFrame([*pairs, (None, 3), (4, None)], "x long, y long").withColumn("a", F.lit(1))
    found = {r.node: r.root for r in components.components(df, "x", "y").collect()}
    nodes = {n for p in pairs for n in p if p[0] != p[1]}
    assert found == union([p for p in pairs if p[0] != p[1]], nodes)
    assert components.components(df.limit(0), "x", "y").count() == 0


def plain_print(text):
    own = words(lower(text))
    runs = [" ".join(own[k : k + 3]) for k in range(len(own) - 2)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_definition(spark):
    rows = [*TEXTS, *[(k, BASE + f" tail{k % 9}" * (k % 3)) for k in range(20, 60)]]
    prints = [plain_print(t) for _, t in rows]
    links = [(a, b) for a, b in itertools.product(set(prints), repeat=2) if (a ^ b).bit_count() <= 2]
    roots = union(links, set(prints))
    least = {}
    for (key, _), p in zip(rows, prints, strict=True):
        if key is not None:
            least[roots[p]] = min(least.get(roots[p], key), key)
    expected = [(key, p, least.get(roots[p])) for (key, _), p in zip(rows, prints, strict=True)]
    found = simhash.near_duplicates(frame(spark, rows), "doc_id").collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in found), key=order) == sorted(expected, key=order)
    assert simhash.near_duplicates(frame(spark).limit(0), "doc_id").count() == 0


def test_gray_index_finds_all_links_and_divides_full_nodes(spark):
    rng = np.random.default_rng(3)
    made = set()
    for base in rng.integers(0, 2**63, 40).tolist():
        for _ in range(20):
            made.add(base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)))
    prints = sorted(made)
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    expected = union(links, prints)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for node_rows in (4096, 6):
        found = simhash.link_fingerprints(df, 2, node_rows).collect()
        roots = union([(r.a % 2**64, r.b % 2**64) for r in found], prints)
        assert all((r.a % 2**64, r.b % 2**64) and expected[r.a % 2**64] == expected[r.b % 2**64] for r in found)
        assert roots == expected


def test_lines_against_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(300)]
    made = [" ".join(rng.choices(vocabulary, k=rng.randint(8, 60))) for _ in range(60)]
    rows = []
    for doc in range(60):
        own = []
        for _ in range(6):
            line = rng.choice(made).split(" ")
            for _ in range(rng.randint(0, 2)):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            own.append(" ".join(line))
        rows.append((doc, "\n".join([*own, "short"])))
    rows += [(None, rows[3][1]), (61, None), (62, ""), (63, "日本語の文章はここにありますそして続きます" * 2), (64, "x日本語の文章はここにありますそして続きます" * 2)]
    rows.append(rows[7])
    placed = {}
    for key, text in set(rows):
        for n, line in enumerate((text or "").split("\n")):
            if len(line) >= 20:
                placed.setdefault(line, []).append(((key is None, key or 0), n))
    sets = {x: {x[k : k + 5] for k in range(len(x) - 4)} for x in placed}
    links = [(a, b) for a, b in itertools.combinations(placed, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    roots, groups = union(links, list(placed)), {}
    for line, places in placed.items():
        groups.setdefault(roots[line], []).extend(places)
    gone = {}
    for places in groups.values():
        for place in places:
            if place != min(places):
                gone.setdefault(place[0], set()).add(place[1])
    found = lines.remove_repeats(frame(spark, rows), "doc_id").select("doc_id", "text", "n_lines", "n_removed", "pieces").collect()
    assert len(found) == len(rows) and len(links) > 50
    texts = dict(rows)
    for r in found:
        own = (texts[r.doc_id] or "").split("\n")
        left = [x for n, x in enumerate(own) if n not in gone.get((r.doc_id is None, r.doc_id or 0), ())]
        assert (r.text, r.n_lines, r.n_removed) == ("\n".join(left), len(own), len(own) - len(left))


def test_lines_of_one_bucket_with_interleaved_groups(spark):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    groups = [list("".join(rng.choices(letters, k=60))) for _ in range(8)]
    texts = []
    for k in range(32):  # four near copies of each
        own = groups[k % 8].copy()
        own[30 + k // 8] = "#"
        texts.append((k, "".join(own)))
    texts += [(32 + k, "".join(rng.choices(letters, k=60))) for k in range(6)]
    lines_ = spark.createDataFrame(texts, "id long, line string")
    met = lines_.select(F.lit(1).alias("band"), "id")
    sets = {k: {x[j : j + 5] for j in range(len(x) - 4)} for k, x in texts}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    found = {r.id: r.root for r in lines.linked(met, lines.line_texts(met, lines_), 0.8).collect()}
    assert found == union(links, list(sets)) and len(set(found.values())) == 14


def test_lines_that_share_many_buckets_share_their_leaders(spark, monkeypatch):
    """Pairs and roots grow with the lines, not with the buckets that they share or the rounds of others."""
    made, verified = [], lines.verified
    monkeypatch.setattr(lines, "verified", lambda pairs, *rest: made.append(pairs.count()) or verified(pairs, *rest))
    base = "".join(random.Random(3).choices("abcdefghij", k=90))
    lines_ = spark.createDataFrame([(k, f"{base}{k:03d}") for k in range(200)], "id long, line string")
    met = lines_.select("id", F.explode(F.sequence(F.lit(1), F.lit(25))).alias("band"))
    found = {r.root for r in lines.linked(met.select("band", "id"), lines.line_texts(met, lines_), 0.8).collect()}
    assert found == {0} and sum(made) < 200 * 20  # of 19,900; with other leaders in each bucket about 150 each


def test_signatures_find_single_letter_edits(spark):
    rng = random.Random(9)
    shingles = lambda x: {x[j : j + 5] for j in range(len(x) - 4)}
    made, chance = [], []
    while len(made) < 1200:
        x = " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(6, 12)))
        y = list(x)
        for place in rng.sample(range(len(x)), max(1, len(x) // 60)):
            y[place] = "#"
        a, b = shingles(x), shingles("".join(y))
        if (s := len(a & b) / len(a | b)) >= 0.8:
            made += [x, "".join(y)]
            chance.append(1 - (1 - s**lines.ROWS) ** lines.BANDS)
    pair = "abcdefghijklmno pqrstuvwxyzabcd fghijklmnopqrst vwxyzabcdefghijk"
    made += [pair, f"{pair}l"]  # 64 and 65 characters with 3 spaces
    made += ["quick brown foxes jump over lazy dogs in a  fence near the river"[:64], "quick brown foxes jump over lazy dogs in a  fence near the rivers"]
    signed = lines.signatures(spark.createDataFrame(list(enumerate(made)), "id long, line string"))
    bands = {r.id: set(r.bands) for r in signed.collect()}
    met = [bool(bands[k] & bands[k + 1]) for k in range(0, len(made), 2)]
    assert np.mean(met[:600]) > np.mean(chance) - 0.008 and all(met[600:])


def test_lines_of_a_family_are_not_all_compared(spark, monkeypatch):
    """Lines of a similarity of about 0.7 share a bucket: marks settle most pairs, and lose no link."""
    made, verified = [], lines.verified
    monkeypatch.setattr(lines, "verified", lambda pairs, *rest: made.append(pairs.count()) or verified(pairs, *rest))
    rng = random.Random(6)
    base, texts = rng.choices("abcdefghijklmnop", k=300), []
    for k in range(160):
        own = base.copy()
        for place in rng.sample(range(300), rng.choice([3, 6, 9])):
            own[place] = rng.choice("QRSTUVWXYZ")
        texts.append((k, "".join(own)))
    lines_ = spark.createDataFrame(texts, "id long, line string")
    met = lines_.select(F.lit(1).alias("band"), "id")
    sets = {k: {x[j : j + 5] for j in range(len(x) - 4)} for k, x in texts}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    found = {r.id: r.root for r in lines.linked(met, lines.line_texts(met, lines_), 0.8).collect()}
    assert found == union(links, list(sets)) and 1 < len(set(found.values())) and sum(made) < 2000  # of 12,720


def test_prints_keep_unlike_lines_apart(spark, monkeypatch):
    made, verified = [], lines.verified
    monkeypatch.setattr(lines, "verified", lambda pairs, *rest: made.append(pairs.count()) or verified(pairs, *rest))
    rng = random.Random(11)
    texts = [(k, "".join(rng.choices("abcdefghij", k=rng.choice([40, 90, 250])))) for k in range(120)]
    texts += [(200 + k, f"{x}#") for k, x in texts[:20]]
    lines_ = spark.createDataFrame(texts, "id long, line string")
    met = lines_.select(F.lit(1).alias("band"), "id")
    signed = lines.signatures(lines_)
    found = {r.id: r.root for r in lines.linked(met, lines.line_texts(met, lines_), 0.8, prints=signed).collect()}
    assert found == {k: k - 200 if k >= 200 else k for k, _ in texts} and sum(made) < 300  # of 9,730


def test_signatures_of_lines_that_repeat_themselves(spark):
    rng = random.Random(12)
    once = ["".join(rng.choices("abcdefghij ", k=k)) for k in (7, 55, 62, 70, 150, 300)]
    made = [x for own in once for few, many in ((1, 2), (1, 3), (1, 12), (5, 40)) for x in (own * few + own[:4], own * many + own[:4])]
    made += ["-" * 12, "-" * 500]
    signed = {r.id: set(r.bands) for r in lines.signatures(spark.createDataFrame(list(enumerate(made)), "id long, line string")).collect()}
    shingles = lambda x: {x[j : j + 5] for j in range(len(x) - 4)}
    pairs = [(k, k + 1) for k in range(0, len(made), 2) if len(shingles(made[k]) & shingles(made[k + 1])) >= 0.8 * len(shingles(made[k]) | shingles(made[k + 1]))]
    assert len(pairs) > 20 and all(signed[a] & signed[b] for a, b in pairs)


def test_short_lines_of_the_query(spark, tmp_path):
    from millrace.llm import queries

    rows = [(1, "menu\n\nread more\n读\nread  all of it"), (2, "read more\n\n \nmenu\nmenus\n读"), (3, "read  all of it!\n\nok")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op6_line_dedup(spark, str(tmp_path)).collect()}
    assert {k: (r.n_lines, r.n_removed) for k, r in found.items()} == {1: (5, 0), 2: (6, 3), 3: (3, 1)}
    assert found[2].kept_sha256 == hashlib.sha256(b"\n \nmenus").hexdigest()


def test_lines_of_an_empty_table(spark):
    assert lines.remove_repeats(frame(spark).limit(0), "doc_id").count() == 0


def edited(rng, own, share):
    out = []
    for w in own:
        roll = rng.random()
        out += [] if roll < share / 3 else [f"new{rng.randrange(99)}"] if roll < 2 * share / 3 else [w, "more"] if roll < share else [w]
    return out


def test_leaks_are_found_edited_or_not(spark):
    rng = random.Random(2)
    vocabulary = [f"v{k}" for k in range(400)] + ["the", "of", "and", "to"] * 40
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(20, 60)))) for k in range(20)]
    rows, leaks = [], set()
    for doc in range(200):
        own = rng.choices(vocabulary, k=rng.randint(5, 300))
        if doc % 4 == 0:
            item, text = rng.choice(items)
            own[5:5] = edited(rng, text.split(), rng.choice([0, 0.1, 0.25]))
            leaks.add((doc, item))
        rows.append((doc, " ".join(own).capitalize() + "."))
    docs = frame(spark, [*rows, *TEXTS[3:7], (None, items[0][1])])
    bench = spark.createDataFrame([*items, (99, None), (98, ""), (97, "a b")], "item_id long, text string")
    for chars in (10**6, 700):
        found = decontaminate.contaminated(docs, bench, "doc_id", "item_id", block_chars=chars).collect()
        assert {(r.doc_id, r.item_id) for r in found} == leaks | {(None, 0)}
    whole = [r for r in found if r.doc_id is None][0]
    assert (whole.score, whole.from_word, whole.to_word) == (1.0, 0, len(items[0][1].split()) - 1)
    assert decontaminate.contaminated(docs, bench.limit(0), "doc_id", "item_id").count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench, "doc_id", "item_id").count() == 0


def test_alignment_against_the_recurrence():
    rng = np.random.default_rng(4)
    queries = [rng.integers(1, 5, rng.integers(1, 12)) for _ in range(40)]
    targets = [rng.integers(1, 5, rng.integers(1, 30)) for _ in range(40)]
    best, _ = decontaminate.align(queries, targets)
    for q, t, b in zip(queries, targets, best, strict=True):
        h = np.zeros((len(q) + 1, len(t) + 1), int)
        for i, j in itertools.product(range(1, len(q) + 1), range(1, len(t) + 1)):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if q[i - 1] == t[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert h.max() == b


NOISY = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar">
<header id=top><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li>News</ul></nav>
<div class="cookie-notice">We use cookies</div><div class="adBox"><p>Buy</p></div>
%s<aside>Other</aside><form><label>Name</label><input name=a></form>
<section id="comments"><article class="comment"><p>First!</article></section>
<script>if (a < b) document.write("<p>no</p>")</script><footer>&copy; me</footer></body></html>"""


def test_pages_keep_the_article_alone(spark):
    body = "<article class='post'><h1>A &amp; B</h1><p>One<b>two</b> three<br>four<p>Fi&eacute;ve &lt;six&gt;<div class='share'>Share</div>%s</article>"
    rows = [(k, f"http://h.example/{k}", NOISY % (body % f"<p>page {k}")) for k in range(6)]
    rows += [(6, "http://one.example", NOISY % "<div class=text><p>no article <i>here</i></div>"), (7, None, None), (8, "x", ""), (9, "", "plain & text <")]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine")).withColumn("host", F.lit(1))
    found = {r.page_id: r for r in pages.extract(df).collect()}
    for k in range(6):
        assert found[k].text == f"A & B Onetwo three four Fiéve <six> page {k}"
        assert found[k].n_chars == len(found[k].text)
    assert [found[k].text for k in (6, 7, 8, 9)] == ["no article here", "", "", "plain & text <"]
    assert pages.extract(df).count() == len(rows) and pages.extract(df.limit(0)).count() == 0


def test_style_tree_drops_unnamed_branches(spark):
    page = "<body><div class=x1><p>same on all</p></div><div class=x2><p>own text %s</p><p>more %s</p></div></body>"
    rows = [(k, "https://h.example/a", page % (k, k * 7)) for k in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in pages.extract(df).collect()} == {f"own text {k} more {k * 7}" for k in range(20)}


def test_tree_finds_the_text_without_telling_names(spark):
    rng = random.Random(4)
    said = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    plain = "<body><div class=k1><a href=x>%s</a></div><div class=k2><h1>%s</h1><div class=k3>%s</div><p>%s</p></div><div class=k4>%s</div></body>"
    other = "<body><table class=m><tr><td>%s</td></tr></table><div class=n><p>%s</p><p>%s</p></div></body>"
    rows, expected = [], {}
    for k in range(40):  # two templates on one host; a third of the articles is shorter than what surrounds them
        long = 4 if k % 3 == 0 else 80
        if k % 4:
            parts = [said(3), said(4), said(long), said(long), said(5)]
            rows.append((k, "http://h.example", plain % tuple(parts)))
            expected[k] = " ".join(parts[1:4])
        else:
            parts = [said(6), said(long), said(long)]
            rows.append((k, "http://h.example", other % tuple(parts)))
            expected[k] = " ".join(parts[1:])
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in pages.extract(df).collect()} == expected


def test_entropies_and_masses_against_their_definition(spark):
    rng = random.Random(6)
    trees = []  # (class of the section, its texts) of each page
    for _ in range(30):
        trees.append([(rng.choice("uvw"), [rng.choice(["same", "often", f"own {rng.random()}"]) for _ in range(rng.randint(0, 3))]) for _ in range(rng.randint(1, 3))])
    html = ["<body>" + "".join(f"<section class={c}>" + "".join(f"<p>{t}</p>" for t in texts) + "</section>" for c, texts in tree) + "</body>" for tree in trees]
    df = spark.createDataFrame([(f"http://h.example/{k}", h) for k, h in enumerate(html)], "url string, html string")
    found = {r.path: r for r in pages.style_tree(df).collect()}
    body = pages._hash("0 body ")
    for name in "uvw":
        path = pages._hash(f"{body} section {name}")
        layouts, blocks = {}, {}
        for k, tree in enumerate(trees):
            for layout in {len(texts) for c, texts in tree if c == name}:
                layouts.setdefault(layout, []).append(k)
            for text in {t for c, texts in tree if c == name for t in texts}:
                blocks[text] = blocks.get(text, 0) + 1
        total = sum(map(len, layouts.values()))
        entropy = -sum(len(p) / total * np.log(len(p) / total) for p in layouts.values()) / np.log(30)
        evenness = {t: np.log(n) / np.log(30) for t, n in blocks.items()}  # a block lies evenly on its n pages
        wanted = pages.PRESENTATION * min(entropy, 1) + (1 - pages.PRESENTATION) * (1 - sum(n * evenness[t] for t, n in blocks.items()) / sum(blocks.values()))
        mass = sum(n * len(t) * (1 - evenness[t]) for t, n in blocks.items()) / total
        assert (found[path].parent, found[path].of, found[path].pages) == (body, 30, total)
        assert abs(found[path].mass - mass) < 1e-9
        assert abs(found[path].importance - wanted) < 1e-9


def test_repair_is_cheapest_in_any_grouping():
    for n in range(1, 5):
        for roles in itertools.product(range(4), repeat=n):
            costs = []
            for states in itertools.product(range(1, 4), repeat=n):
                steps = [chat.STEPS[a, r].get(b) for a, r, b in zip((0, *states), roles, states, strict=False)]
                if all(steps):
                    costs.append(sum(s[0] for s in steps) + chat.ENDING[states[-1]])
            for cut in range(1, n + 1):
                parts = [list(p) for p in (roles[:cut], roles[cut:]) if p]
                cost, states = chat.settle([chat.matrix(p) for p in parts])
                assert cost == min(costs)
                for part, a, b in zip(parts, states, states[1:], strict=False):
                    assert len(chat.trace(a, b, part)) == len(part)


def test_rendered_conversations_are_legal(spark):
    rng = random.Random(8)
    names = ["user", "Human", "assistant", "gpt", "system", "tool", None]
    rows = [(c, t, rng.choice(names), f"m{t}") for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(50, t, rng.choice(names), "x<|end|>y") for t in range(600)] + [(None, None, "user", None), (None, 2, None, "")]
    rows += [(60, 0, "assistant", "hi"), (61, 0, "system", "s"), (62, 1, "user", "same"), (62, 1, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    found = chat.repaired(df, "conv_id").collect()
    assert len(found) == len(rows)
    for key in {r[0] for r in rows}:
        own = sorted((r for r in found if r.conv_id == key), key=lambda r: (r.turn is None, r.turn or 0, r.role or ""))
        text = "".join(r.rendered for r in own)
        messages = re.findall(r"<\|(\w+)\|>\n(.*?)<\|end\|>\n", text, re.S)
        assert "".join(f"<|{a}|>\n{b}<|end|>\n" for a, b in messages) == text
        state = 0
        for role, _ in messages:
            assert chat.ROLES.index(role) in chat.FOLLOWS[state]
            state = chat.ROLES.index(role) + 1
        assert state > 1
        assert [p for _, b in messages if b for p in b.split(chat.SEPARATOR) if p] == [r.text.replace("<|", "<\\|") for r in
            sorted((x for x in df.collect() if x.conv_id == key), key=lambda r: (r.turn is None, r.turn or 0, r.role or "")) if r.text]
    first = {r.conv_id: (r.action, r.inserted, r.cost) for r in found if r.conv_id in (60, 61)}
    assert first[60] == ("keep", ["user"], 2) and first[61][2] == 2
    assert chat.repaired(df.limit(0), "conv_id").count() == 0


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    small = folder.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, small))
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(ids) <= seen and len(ids) == len(set(ids))
        seen = set(ids)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert docs.filter("NOT lossless").count() == 0
    labels = spark.read.parquet(f"{small}/labels.parquet").collect()
    good, bad = ([r.doc_id for r in labels if r.quality == q] for q in (1, 0))
    assert np.mean([d in seen for d in good]) > 0.7 and np.mean([d in seen for d in bad]) < 0.05


def test_line_stage_of_the_pipeline_keeps_what_is_left(spark):
    import corpus_pipeline

    shared, own = "a long line that stands in two of the documents here", "the only line of its kind, a short end"
    rows = [(1, "\n".join([shared] * 4)), (2, f"{shared}\n{own}"), (3, f"{shared}\n\n{shared}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'web' AS source", "0L AS n_chars")
    found = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert found == {1: (shared, len(shared)), 2: (own, len(own))}


def test_a_passage_reaches_back_to_the_earliest_place_its_hits_ask_for():
    items = decontaminate.index_items([1], ["one two three four five six seven eight nine ten"])
    seeds = {int(c): [(0, int(o))] for c, o in zip(items.gram_code, items.gram_offset, strict=True)}
    late = decontaminate.Reader(items)
    words = late.numbers(b"x x x x x x x x x x x x one two three x x x six seven eight nine ten x x")
    at, codes = late.hits(words)
    order = list(zip(at.tolist(), codes.tolist(), strict=True))[::-1]  # the last hit first
    found = decontaminate.passages_of(items, seeds, np.array([a for a, _ in order]), np.array([c for _, c in order]), len(words))
    starts = [max(a - o - 8, 0) for a, c in order for _, o in seeds[c]]
    assert len(found) == 1 and found[0][1] == min(starts)
