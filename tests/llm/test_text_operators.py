"""Quality, mixing, decontamination, pseudonyms, licences and quotations."""

import collections
import math
import re

import numpy as np
from pyspark.sql import functions as F

from creditflow.llm import licenses, quality
from creditflow.llm import queries as Q
from creditflow.llm.decontamination import decontaminate
from creditflow.llm.mixing import DOMAINS, TARGETS, fit_rates, mix
from creditflow.llm.pseudonyms import pseudonymise
from creditflow.llm.quotations import link_quotations
from tests.llm import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, shard int"


def test_base_rules_and_perplexity(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    counts, codes = collections.defaultdict(collections.Counter), {}
    for r in docs.values():
        sym = [0, 0, 0] + [int(quality._FOLD[b]) for b in r.text.encode()]
        codes[r.doc_id] = [tuple(sym[i - 3:i + 1]) for i in range(3, len(sym))]
        counts[r.lang].update(codes[r.doc_id])
    p = {lang: brute.kneser_ney(c) for lang, c in counts.items()}
    out = Q.op10_quality_rules(spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_rules(docs[r.doc_id].text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    for r in out[:25]:
        own = codes[r.doc_id]
        want = -sum(math.log(p[r.lang](g)) for g in own) / max(len(own), 1)
        assert abs(r.nats - want) < 1e-4


def test_bands_reject_on_both_sides(spark):
    """``kept`` recomputed from the scores; random letters go, clean documents stay."""
    rng = np.random.default_rng(7)
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang").collect()]
    noise = [(100_000 + i, " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(30 + 10 * i)), "en") for i in range(50)]
    rows = quality.quality_rules(spark.createDataFrame(docs + noise, "doc_id long, text string, lang string")).collect()
    bands = {}
    for lang in {r.lang for r in rows}:
        bins = np.sort([math.floor(r.nats / quality.BIN) for r in rows if r.lang == lang and not r.base_failed])
        bands[lang] = [(bins[max(0, math.ceil(q * len(bins)) - 1)] + edge) * quality.BIN for q, edge in ((0.25, 0), (0.75, 1))]
    for r in rows:
        q1, q3 = bands[r.lang]
        wide = (q3 - q1) * math.sqrt(1 + 100 / max(r.n_words, 1))
        inside = q1 - quality.LOW_IQRS * wide <= r.nats <= q3 + quality.HIGH_IQRS * wide
        assert r.kept == (not r.base_failed and inside), (r.doc_id, r.nats, r.lang)
    assert sum(r.kept for r in rows if r.doc_id >= 100_000) <= 5
    passing = [r for r in rows if r.doc_id < 100_000 and not r.base_failed]
    assert sum(r.kept for r in passing) >= 0.97 * len(passing)


def test_null_and_empty_languages_are_two(spark):
    text = "one text of some words that is scored under two languages or more"
    rows = [(1, text, None), (2, "qq zz xx " * 20, ""), (3, text, "xx"), (4, "qq zz xx " * 20, "\0")] + [(i, f"short row {i}", f"l{i}") for i in range(10, 200)]
    out = {r.doc_id: r.nats for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert out[1] == out[3] and out[2] == out[4] and len(out) == len(rows)


def test_model_is_a_distribution():
    rng = np.random.default_rng(4)
    raw = np.unique(rng.integers(0, 1 << 24, 3000) & 0x0C3_0C3)
    model = quality.kneser_ney(raw, rng.integers(1, 6, len(raw)))
    context = int(raw[5]) >> 6
    assert abs(np.exp(quality.log_prob(model, (context << 6) + np.arange(64))).sum() - 1) < 1e-5


def test_quality_awkward(spark):
    rows = [(None, None, None, 1), (1, "", None, 2), (2, "a " * 30, "xx", 3), (2, "a " * 30, "xx", 3), (3, "one two three four " * 9000, "en", 4),
            (4, " ".join(f"word{i}" for i in range(50)), "en", 5)]
    out = quality.quality_rules(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed) for r in out) == [(0, 0, True), (1, 0, True), (2, 30, True), (2, 30, True), (3, 36000, True), (4, 50, False)]
    assert [r.kept for r in out if r.doc_id == 4] == [True]
    assert quality.quality_rules(spark.createDataFrame(rows, DOCS).limit(0)).collect() == []


QUESTION = "Alice has 5 apples and Bob has 7 km to go. Alice gives Bob 5 more of them today."


def test_decontaminate_slots(spark):
    docs = spark.createDataFrame([
        (1, f"Hi. {QUESTION} end", "en", 0), (2, "x y Alice has 9 apples and Tom has 3 km to go. Alice gives Tom 9 more of them today.", "en", 0),
        (3, QUESTION.replace("5 more", "8 more").replace("7", "6"), "en", 0), (4, None, None, 0), (5, "", None, 0), (6, "so Alice has 5 apples", "en", 0),
        (7, "two words", "en", 0), (7, "two words", "en", 0)], DOCS)
    items = spark.createDataFrame([(0, QUESTION, 1), (1, None, 1), (2, "", 1), (3, "two words", 1)], "item_id long, text string, h long")
    out = {(r.doc_id, r.item_id, r.same_values) for r in decontaminate(docs, items).collect()}
    # 3: one value of the item stands for two in the document
    assert out == {(1, 0, True), (2, 0, False), (7, 3, True)}
    assert decontaminate(docs.limit(0), items).collect() == [] == decontaminate(docs, items.limit(0)).collect()


def test_decontaminate_finds_edited_copies(spark):
    names = ["Tom", "Anna"]
    item = [names[i // 10 % 2] if i % 10 == 3 else f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50)]
    put = lambda i, *new, gone=0: " ".join(["so", "on", *item[:i], *new, *item[i + gone:], "end"])
    texts = [put(25, "extra"), put(25, gone=1), put(25, "other", gone=1), put(25, *"some words put in between".split()), put(23, "he", gone=1), put(23, "Otto", gone=1),
             put(25, "extra").replace("Tom", "Ute"), " ".join(item[25:37])]
    # names at sentence starts and after a line break, and two copies with other values one after the other
    start = "Carla took three of the red pears home. Dave\nate them at once before noon. Carla then asked for many more of those."
    other = start.replace("Carla", "Emil").replace("Dave", "Fred")
    texts += [other, other.replace("home", "away"), f"{start} {other}", other.replace("Emil then", "Gus then")]
    docs = spark.createDataFrame([(i, x, "en", 0) for i, x in enumerate(texts)], DOCS)
    out = {(r.doc_id, r.item_id): r for r in decontaminate(docs, spark.createDataFrame([(0, " ".join(item)), (1, start)], "item_id long, text string")).collect()}
    assert sorted(out) == [*((i, 0) for i in range(7)), (8, 1), (10, 1)]
    assert [out[i, 0].n_hits for i in range(7)] == [42, 41, 41, 42, 41, 41, 42]
    assert [out[i, 0].same_values for i in range(7)] == [True] * 6 + [False]
    assert out[0, 0].at_word == 2 and not out[8, 1].same_values and out[10, 1].same_values


def test_decontaminate_finds_planted_items(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    planted = {(d.doc_id, i) for d in docs for i, t in items if t in d.text}
    assert planted and {(r.doc_id, r.item_id) for r in Q.op4_benchmark_decontamination(spark, SF).collect()} == planted


def test_decontaminate_asks_for_literal_words(spark):
    items = [(0, "1 2 3 4 5 6 7 8"), (1, "Berlin Paris London Madrid Rome Vienna"), (2, "5 + 3 = 8 and so on"), (3, "7 km")]
    texts = ["10 20 30 40 50 60 70 80", "Alpha Beta Gamma Delta Epsilon Zeta", "so 1 2 3 4 5 6 7 8 9", "in BERLIN Paris London Madrid Rome Vienna", "9 + 4 = 13", "9 + 4 = 13 and so on", "7 km", "8 km"]
    docs = spark.createDataFrame([(i, x, "en", 0) for i, x in enumerate(texts)], DOCS)
    out = {(r.doc_id, r.item_id, r.same_values) for r in decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    # 5: the one window of the item's four that is all slots has other values, three of four are under 80 %
    assert out == {(2, 0, True), (3, 1, True), (6, 3, True)}


def test_decontaminate_against_brute_force(spark):
    rng = np.random.default_rng(11)
    words = ["the", "of", "pears", "red", "Anna", "Tom", "Rome", "3", "14", "km", "+", "runs", "to", "7,5"]
    pick = lambda n: " ".join(words[k] for k in rng.integers(0, len(words), n))
    items = [(i, pick(int(n))) for i, n in enumerate(rng.integers(1, 30, 25))]
    docs = []
    other = {"Anna": "Otto", "Tom": "Ida", "Rome": "Oslo", "3": "9", "14": "21", "7,5": "8,1"}
    for i in range(500):
        own = items[i % 25][1].split()
        if i % 3 == 0:
            own = [other.get(w, w) for w in own]
        for _ in range(i % 4):
            own[int(rng.integers(len(own)))] = words[int(rng.integers(len(words)))]
        docs.append((i, f"{pick(i % 7)} {' '.join(own)} {pick(i % 5)}"))
    docs += [(1000, None), (1001, " \n"), (1002, pick(20_000))]
    docs += [(2000 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    out = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute.decontaminate(docs, items)
    assert {(r.doc_id, r.item_id): (r.n_windows, r.n_hits, r.at_word, r.same_values) for r in out} == want
    assert len(want) > 100 and len({v[3] for v in want.values()}) == 2


def _luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def test_pseudonyms(spark):
    rows = [(1, "Pay 4111 1111 1111 1111 or 4111-1111-1111-1111, not 4111111111111112. Call +1 (389) 555-5010."), (2, None), (3, ""),
            (4, "on 2024-02-29 or 29.02.2024 or 02/29/2024, not 2023-02-29; ip 192.168.0.1, not 300.1.1.1; ssn 123-45-6789, not 666-12-3456"), (5, "4111111111111111")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, found int")
    out = {r.doc_id: r for r in pseudonymise(docs, "k").collect()}
    one, two = re.search(r"Pay ([\d ]+) or ([\d-]+), not 4111111111111112", out[1].text).groups()
    assert _luhn(one) and one.replace(" ", "") == two.replace("-", "") == out[5].text != "4111111111111111" and len(out[5].text) == 16
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}\.$", out[1].text) and "555-5010" not in out[1].text
    assert out[2].text is None and out[3].text == ""
    y, m, d = re.search(r"on (\d{4})-(\d\d)-(\d\d)", out[4].text).groups()
    assert f"{d}.{m}.{y}" in out[4].text and f"{m}/{d}/{y}" in out[4].text and "2023-02-29" in out[4].text and "300.1.1.1" in out[4].text and "666-12-3456" in out[4].text
    assert (out[4].n_date, out[4].n_ip, out[4].n_ssn, out[1].n_card, out[1].n_phone) == (3, 1, 1, 2, 1)
    assert pseudonymise(docs, "other").collect() != pseudonymise(docs, "k").collect()
    assert pseudonymise(docs.limit(0)).collect() == []


def test_pseudonyms_permute_their_domain(spark):
    days = spark.sql("select id as doc_id, date_format(date_add(date'1800-01-01', cast(id * 7 as int)), 'yyyy-MM-dd') as text from range(20871)")
    r = pseudonymise(days).agg(F.countDistinct("text"), F.sum("n_date"), F.min("text") >= "1800-01-01", F.max("text") <= "2199-12-31").first()
    assert tuple(r) == (20871, 20871, True, True)
    ssns = spark.sql("select id as doc_id, format_string('%03d-%02d-%04d', 1 + id % 600, 1 + id % 99, 1 + id) as text from range(5000)")
    assert tuple(pseudonymise(ssns).agg(F.countDistinct("text"), F.sum("n_ssn")).first()) == (5000, 5000)


def test_pseudonyms_leave_the_rest_of_a_text(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in Q.op8_pii_pseudonyms(spark, SF).collect():
        changed = r.n_card + r.n_phone + r.n_ssn + r.n_ip + r.n_date
        assert (r.text == docs[r.doc_id]) == (changed == 0)
        assert re.sub(r"[0-9.]", "", r.text) == re.sub(r"[0-9.]", "", docs[r.doc_id])


def _shingles(text):
    w = re.findall(brute.WORD, (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_licenses(spark):
    texts = dict(licenses.NOTICES)
    rows = [(1, "x y " + texts["MIT"] + " tail"), (2, None), (3, ""), (4, texts["MIT"].replace("merge", "m")), (5, "a b c\n" + texts["ISC"].upper()), (6, "q " * 9 + texts["BSD-3-Clause"])]
    rows += [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = set()
    for i, t in rows:
        for name, notice in licenses.NOTICES:
            own = _shingles(notice)
            if 100 * len(own & _shingles(t)) >= 80 * len(own):
                want.add((i, name))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, band long")
    assert {(r.doc_id, r.license_id) for r in licenses.scan_licenses(docs, licenses.notices(spark)).collect()} == want
    assert licenses.scan_licenses(docs.limit(0), licenses.notices(spark)).collect() == []


def test_licenses_without_a_literal_word(spark):
    templates = spark.createDataFrame([("N", "1 2 3 4 5 6"), ("S", "one two three")], "license_id string, text string")
    docs = spark.createDataFrame([(1, "x 1 2 3 4 5 6 y"), (2, "1 2 3 4 5 7"), (3, "one two three"), (4, "1 2"), (5, "1 2 3 4 5 6")], "doc_id long, text string")
    assert sorted((r.doc_id, r.license_id, r.n_shingles, r.n_shared) for r in licenses.scan_licenses(docs, templates).collect()) == [(1, "N", 2, 2), (5, "N", 2, 2)]


def test_mixing_moves_towards_its_targets(spark):
    out = Q.op7_source_mixing(spark, SF).toPandas()
    goal = np.array([TARGETS[d] for d in DOMAINS]) * out["n_tokens"].sum()
    members = out[[f"p_{d}" for d in DOMAINS]].to_numpy() * out["n_tokens"].to_numpy()[:, None]
    gap = lambda rate: np.abs(members.T @ rate - goal).sum()
    assert (out["rate"] >= 0).all() and gap(out["rate"].to_numpy()) < 0.5 * gap(np.ones(len(out)))


def test_rates_of_known_members(spark):
    rows = [(100, 1.0, 0.0, 0.0)] * 8 + [(100, 0.0, 1.0, 0.0)] + [(100, 0.0, 0.0, 1.0)]
    out = fit_rates(spark.createDataFrame(rows, "n_tokens long, p_good double, p_low double, p_toxic double"), {"good": 0.9, "low": 0.1, "toxic": 0.0})
    assert sorted({(r.p_good, r.p_low, round(r.rate, 6)) for r in out.collect()}) == [(0.0, 0.0, 0.0), (0.0, 1.0, 1.0), (1.0, 0.0, 1.125)]


def test_classifier_finds_toxic_words(spark):
    docs = [(i, " ".join(f"w{(i * 7 + j) % 40}" for j in range(30)) + (" vile" if i % 5 == 0 else "")) for i in range(400)] + [(None, None), (None, "")]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(300)] + [(None, 1, 1), (3, None, 1), (5, 1, 1)]
    out = mix(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in out if r.doc_id is not None and r.doc_id >= 300]
    assert all((r.p_toxic > 0.5) == (r.doc_id % 5 == 0) for r in held)
    empty = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").limit(0)
    assert {r.rate for r in mix(spark.createDataFrame(docs[:3], "doc_id long, text string"), empty).collect()} == {1.0}


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = mix(docs, labels.where("doc_id % 2 = 1")).drop("text").join(labels.where("doc_id % 2 = 0"), "doc_id").toPandas()
    toxic, clean = out[out.toxic == 1], out[(out.toxic == 0) & (out.quality == 1)]
    assert (toxic.p_toxic > 0.5).mean() > 0.7 and (clean.p_toxic > 0.5).mean() < 0.01


CHAT = "conv_id long, turn long, role string, text string, at int"


def test_quotations(spark):
    rows = [(1, 0, "u", "Hello there\nHow are you?"), (1, 1, "a", "fine"), (1, 2, "u", "> how  ARE you?\n\nI am ok"), (1, 3, "a", ">> How are you?\n> I am ok\ngood"),
            (1, 4, "u", None), (1, 5, "a", "> hello there\n> how are\n> you?\nhm"), (2, 0, "u", "> nothing"), (None, 1, "u", "> x"), (2, None, "u", "> y")]
    out = {(r.conv_id, r.turn): r for r in link_quotations(spark.createDataFrame([(*r, 9) for r in rows], CHAT)).collect()}
    pick = lambda k: (out[k].reply_to, out[k].position, out[k].n_passages, out[k].n_linked, out[k].max_level, out[k].text)
    assert pick((1, 0)) == (None, 0, 0, 0, 0, "Hello there\nHow are you?")
    assert pick((1, 2)) == (0, 2, 1, 1, 1, "\nI am ok")
    assert pick((1, 3)) == (2, 4, 2, 2, 2, "good")
    assert pick((1, 4)) == (3, 5, 0, 0, 0, None)
    assert pick((1, 5)) == (0, 3, 1, 1, 1, "hm")
    assert pick((2, 0)) == (None, 0, 1, 0, 1, "> nothing")  # a quote of nobody stays
    assert pick((None, 1))[:2] == (None, None) == pick((2, None))[:2]
    assert link_quotations(spark.createDataFrame([(*r, 9) for r in rows], CHAT).limit(0)).collect() == []


def test_quotations_against_brute_force(spark):
    """Re-wrapped, partial, edited and nested quotes, and words that many messages share."""
    rng = np.random.default_rng(5)
    vocab = [f"W{i}" for i in range(25)] + ["thanks,", "the"]
    rows, planted = [], []
    for conv in range(12):
        said = []
        for turn in range(40):
            lines = [" ".join(vocab[k] for k in rng.integers(0, len(vocab), rng.integers(1, 14))) for _ in range(rng.integers(1, 4))]
            own, at = list(lines), turn * 37 % (2500 if conv == 0 else 37 * 41)
            for _ in range(int(rng.integers(0, 3)) if said else 0):
                old, source = said[int(rng.integers(len(said)))]
                words = " ".join(source).split()
                cut = int(rng.integers(0, max(1, len(words) - 3)))
                words = words[cut:cut + int(rng.integers(1, 16))]
                if rng.random() < 0.2:
                    words[int(rng.integers(len(words)))] = "edited"
                elif len(words) >= 8:
                    planted.append((conv, at, old))
                mark, wide = "> " * int(rng.integers(1, 4)), int(rng.integers(2, 9))
                lines[int(rng.integers(0, len(lines) + 1)):0] = [mark + " ".join(words[i:i + wide]).lower() for i in range(0, len(words), wide)]
            said.append((at, own))
            rows.append((conv, at, "\n".join(lines)))
    # turns over several blocks, and one conversation where all say and quote the same
    rows = [(c, t * 97 if c == 1 else t, x) for c, t, x in rows]
    rows += [(99, t, "thanks\n> thanks" if t % 2 else "thanks") for t in range(3000)]
    frame = spark.createDataFrame([(c, t, "u", x, 0) for c, t, x in rows], CHAT)
    out = {(r.conv_id, r.turn): (r.reply_to, r.position, r.n_passages, r.n_linked, r.text) for r in link_quotations(frame).collect()}
    small = [r for r in rows if r[0] != 99]
    want = brute.quotations(small)
    assert {k: v for k, v in out.items() if k[0] != 99} == want and len(planted) > 50
    assert sum(v[3] for v in want.values()) >= 0.9 * len(planted)
    assert all(out[99, t][0] == t - 1 and out[99, t][3:] == (t % 2, "thanks") for t in range(1, 3000))


def test_unquoted_conversations_keep_their_order(spark):
    out = Q.op1_chat_formatting(spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/conversations.parquet").count()
    assert out.where("position <> turn or reply_to <> turn - 1").count() == 0


def test_a_passage_finds_the_message_with_most_windows(spark):
    """Its windows' last holders are all other messages; equal and near-equal owners, the latest wins; repeated windows."""
    words = [f"w{i}" for i in range(23)]
    rows = [(1, 0, " ".join(words)), (1, 1, " ".join(words) + " tail")]
    rows += [(1, 2 + k, " ".join(words[k * 2:k * 2 + 5])) for k in range(10)]
    rows += [(1, 20, "> " + " ".join(words[:22]) + " other\nyes"), (1, 21, "> " + " ".join(words) + "\nyes")]
    rows += [(2, 0, "a b c d e f g h i j"), (2, 1, "a b c d"), (2, 2, "g h i j"), (2, 3, "c d e f"), (2, 2500, "> a b c d e f g h i x\nno"), (2, 2501, "> a b c d q r s t u x\nno")]
    rows += [(3, t, "thanks a lot my friend") for t in range(5)] + [(3, 9, "> thanks a lot my friend\nyes")]

    def windows(text):
        w = text.lower().split()
        return [tuple(w[i:i + 4]) for i in range(len(w) - 3)]

    want = {}
    for c, t, text in rows:
        if text.startswith("> "):
            asked = windows(text.split("\n")[0][2:])
            has = [(sum(w in windows(x) for w in asked), u) for d, u, x in rows if d == c and u < t and not x.startswith("> ")]
            best = max(has)
            want[c, t] = best[1] if 100 * best[0] >= 80 * len(asked) else None
    out = {(r.conv_id, r.turn): r for r in link_quotations(spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")).collect()}
    assert want[1, 20] == 1 and want[2, 2500] == 0 and want[2, 2501] is None
    assert {k: out[k].reply_to if out[k].n_linked else None for k in want} == want
