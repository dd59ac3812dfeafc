"""The ten operators against brute force, and their edge cases, on small tables."""
import hashlib
import random
import re
import zlib
from types import SimpleNamespace

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskweave.llm import (chat, compact_windows, decontamination, digest_index, mixing, privacy, queries, resampling,
                           simhash, suffix_dedup, token_files)
from riskweave.llm.common import Work, connected_components, documents, text_blocks

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, source string, size string, keep_id string, mark string, fp string"
LONG = "alpha beta gamma delta " * 4000


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing columns."""
    rows = [(1, "one two three four", "a"), (1, "one two three four", "a"), (1, "another text of the id", "a"),
            (None, "one two three four", None), (None, None, None), (2, None, "b"), (3, "", "b"), (4, " \t\n", "b"),
            (5, LONG, ""), (6, LONG, ""), (7, "one  two\nthree four", "b"), (8, "word", None)]
    return [(*r, "x", "y", "z", None) for r in rows]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF)


def texts(df):
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}


# ------------------------------------------------------------------ SQL oracles

@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want)


# ------------------------------------------------------------------ 1 resampling

def test_resampling_rejects_the_odd_class(spark):
    rng = random.Random(1)
    good = [f"{a}{b}" for a in "bcdfg" for b in ("arin", "orel", "istu", "embo", "ulaf")]
    bad = [f"zzqx{a}" for a in ("ar", "or", "is")]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 10 == 0
        words = [rng.choice(good) for _ in range(rng.randint(30, 80))]
        if toxic:
            words[5:5] = [rng.choice(bad) for _ in range(4)]
        rows.append((i, " ".join(words)))
        if i % 2 or i % 20 == 0:
            labels.append((i, 1, int(toxic)))
    got = resampling.resample(spark.createDataFrame(rows, "doc_id long, text string"),
                              spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    assert len(kept) == 600
    assert not any(kept[i] for i in range(0, 600, 10))
    assert sum(kept[i] for i in range(600) if i % 10) >= 0.98 * 540


def test_resampling_edges(spark, edges, empty):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    assert resampling.resample(edges, labels).count() == edges.count()
    no_labels = resampling.resample(edges, labels.limit(0))
    assert no_labels.filter("kept").count() == edges.count()
    assert resampling.resample(empty, labels).count() == 0
    assert resampling.resample(edges, labels, k=3).filter("kept").count() >= 3


def test_weights_and_sample_by_hand(spark):
    from collections import Counter
    rng = random.Random(7)
    vocabulary = ["marine", "orbital", "velvet", "cactus", "lantern", "rubble", "zzqxar", "zzqxor"]
    rows = [(i, " ".join(rng.choices(vocabulary, [8, 7, 6, 5, 4, 3, *([2, 2] if i % 9 == 0 else [0, 0])], k=rng.randint(20, 60))))
            for i in range(400)]
    labels = [(i, 1, int(i % 9 == 0)) for i in range(0, 400, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = resampling.LabelSample(marks, 10_000, "doc_id", "quality", "toxic")
    kind = dict(zip(sample.ids.tolist(), sample.kind.tolist(), strict=True))
    assert set(kind) == {d for d, _, t in labels if not t} and set(kind.values()) == {1, 2}

    def grams(text):
        words = text.split()
        return [w[:n] for w in words for n in resampling.PREFIXES if len(w) >= n], words + list(zip(words, words[1:], strict=False))

    scores = {}
    for part in range(2):
        raw, target = Counter(), Counter()
        for i, text in rows:
            raw.update(grams(text)[part])
            if kind.get(i) == 1:
                target.update(grams(text)[part])
        scale = sum(target.values()) / sum(raw.values())
        ratio = {g: np.log((target[g] + 1) / (raw[g] * scale + 1)) for g in raw}
        for i, text in rows:
            found = [ratio[g] for g in grams(text)[part]]
            value = sum(min(x + 1, 0) for x in found) / len(found) ** 0.5 if part == 0 else sum(found) / len(found)
            scores.setdefault(i, []).append(value)
    held = np.array([scores[i] for i in sorted(kind) if kind[i] == 2])
    low, mid = np.quantile(held, resampling.TOLERATED, axis=0), np.quantile(held, 0.5, axis=0)
    weight = {i: resampling.SHARPNESS * min((np.array(s) - low) / np.maximum(mid - low, 1e-9)) for i, s in scores.items()}
    got = {r["doc_id"]: r for r in resampling.resample(docs, marks).collect()}
    assert [got[i]["log_weight"] for i in range(400)] == pytest.approx([weight[i] for i in range(400)], rel=1e-4, abs=1e-3)
    # the sample is the top k of weight and noise
    k = sum(w >= 0 for w in weight.values())
    keys = sorted((r["key"] for r in got.values()), reverse=True)
    assert {i for i, r in got.items() if r["kept"]} == {i for i, r in got.items() if r["key"] >= keys[k - 1]}
    # and the noise decides between near weights: another seed, another sample of the same size
    some = [{r["doc_id"] for r in resampling.resample(docs, marks, k=150, seed=s).filter("kept").collect()} for s in (1, 2)]
    assert [len(x) for x in some] == [150, 150] and some[0] != some[1]
    assert not any("zzq" in text for x in some for i, text in rows if i in x)


def test_kth_largest(spark):
    df = spark.range(300).select(F.xxhash64("id").alias("v"))
    values = sorted((r["v"] for r in df.collect()), reverse=True)
    assert [resampling.kth_largest(df, "v", k) for k in (1, 2, 150, 300)] == [values[k - 1] for k in (1, 2, 150, 300)]
    assert resampling.kth_largest(df, "v", 301) is None


# ------------------------------------------------------------------ 2 chat

def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "<\\s>[\\\\INST]<<s>[[INST]] <", "", None, " <|image|> \n", "[ROLE]x[/ROLE] ", "\\", "<s>"]
    rows = [(c, t, role, said[(c + t) % len(said)]) for c in range(8) for t, role in
            enumerate(["system", "user", "assistant", None, "x[", "assistant"])]
    rows += [(None, None, None, None), (3, 1, "user", "again")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_messages(df, chat.text_parts(F.col("text")))
    got = {r["conv_id"]: r for r in chat.read_conversations(made).collect()}
    assert set(got) == {None, *range(8)}
    assert got[3]["n_turns"] == 7
    for c in (0, 1, 2, 4, 5, 6, 7, None):
        own = [r for r in rows if r[0] == c]
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_conversations(chat.format_messages(df.limit(0), chat.text_parts(F.col("text")))).count() == 0


def test_chat_typed_parts(spark):
    part = "struct<kind:string,text:string,ref:string,amount:double>"
    df = spark.createDataFrame([(1, 0, "user", [("text", "see <|image|> ", None, None), ("image", None, "a.png", 7840.0),
                                                ("audio", None, "b.wav", 2.0), ("document", None, None, None),
                                                (None, " end", None, None)]), (1, 1, "assistant", None)],
                               f"conv_id long, turn long, role string, parts array<{part}>")
    a, b = chat.format_messages(df, F.col("parts")).orderBy("turn").collect()
    assert a["formatted"] == "<s>[INST] see <\\|image|> <|image|><|audio|><|document|> end [/INST]</s>"
    assert [(x["place"], x["kind"], x["ref"], x["tokens"]) for x in a["attachments"]] == [
        (1, "image", "a.png", 10), (2, "audio", "b.wav", 50), (3, "document", None, 1)]
    assert (a["attachment_tokens"], b["formatted"], b["attachments"]) == (61, "<s>  </s>", [])


def test_chat_with_clashing_columns_and_long_texts(spark):
    long = "</s>[INST] " * 60_000
    rows = [(1, 0, "user", long, "a", 1, 2), (1, 1, "assistant", long, "b", 3, 4), (2, None, None, None, None, None, None),
            (2, None, None, None, None, None, None), (None, 5, "tool", "", "c", 5, 6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, loss_start int, body int")
    made = chat.format_messages(df.repartition(2), chat.text_parts(F.col("text")))
    got = {r["conv_id"]: r for r in chat.read_conversations(made).collect()}
    assert set(got) == {1, 2, None} and got[2]["n_turns"] == 2
    assert got[1]["loss_chars"] == len(long) and got[1]["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert got[1]["turns_sha256"] == hashlib.sha256(f"user\n{long}\nassistant\n{long}\n".encode()).hexdigest()


# ------------------------------------------------------------------ 3 mixing

def brute_targets(sizes, share=1.5, most=2, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, held = sum(sizes.values()) * share, set()
    while True:
        level = (total - sum(most * sizes[s] for s in held)) / max(1, sum(w[s] for s in sizes if s not in held))
        more = {s for s in sizes if s not in held and w[s] * level >= most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in held else w[s] * level for s in sizes}
        held |= more


def test_mix_meets_targets(spark, docs):
    got = mixing.mix(docs).collect()
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = brute_targets(sizes)
    text = texts(docs)
    taken = {}
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text[r["doc_id"]]))
        assert r["source_size"] == sizes[r["source"]] and r["taken"] in (0, r["size"], 2 * r["size"])
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2, 0.02 * t)
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_fill_is_optimal():
    rng = random.Random(4)
    for _ in range(200):
        sizes = rng.sample(range(1, 30), rng.randint(1, 5))
        counts = [rng.randint(0, 3) for _ in sizes]
        budget = rng.randint(0, 60)
        sums = {0}
        for s, n in zip(sizes, counts, strict=True):
            sums = {a + s * k for a in sums for k in range(n + 1)}
        taken = mixing.fill(sizes, counts, budget)
        assert all(0 <= k <= n for k, n in zip(taken, counts, strict=True))
        assert sum(s * k for s, k in zip(sizes, taken, strict=True)) == max(x for x in sums if x <= budget)


def test_mix_edges(edges, empty):
    got = mixing.mix(edges).collect()
    assert len(got) == edges.count() and all(r["taken"] <= 2 * r["size"] for r in got)
    assert {r["source"] for r in got} == {None, "", "a", "b"}
    assert mixing.mix(empty).count() == 0


# ------------------------------------------------------------------ 4 privacy

def brute_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = ["a", "b@", "@", ".", "..", "1", "25", "255", "256", "+1", " ", "-", "(", ")", "é", "4111 1111 1111 1111",
             "4111111111111111", "x.y", "%", "٣"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 18)))
        assert privacy.base_spans(t) == brute_spans(t), t


def test_disclosing_terms(spark, edges, empty):
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt".split()
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(filler, k=12))) for i in range(300)]
    rows += [(300 + i, f"{' '.join(rng.choices(filler, k=6))} bluebird77 writes jane@mail.example {rng.choice(filler)} {i}") for i in range(8)]
    rows += [(400, "a note on bluebird77 alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = privacy.find_private(df)
    got = {r["doc_id"]: r for r in privacy.digest_spans(found).collect()}
    assert got[400]["spans"] == "remove:10:20" or got[400]["spans"] == "generalise:10:20"
    assert got[400]["n_email"] == 0 and got[302]["n_email"] == 1
    assert not any(got[i]["spans"] for i in range(300))
    text = {r["doc_id"]: r["text"] for r in privacy.sanitise(df, found).collect()}
    assert "bluebird77" not in text[400] and "jane@" not in text[303] and text[5] == rows[5][1]
    assert privacy.find_private(edges).count() == edges.count()
    assert privacy.find_private(empty).count() == 0


def test_sanitise_edges(spark, edges):
    """Nulls, repeated rows and columns named like the operator's own stay as they are."""
    rows = [(1, "mail jane@mail.example now", "x", "y"), (1, "mail jane@mail.example now", "x", "y"), (1, "other jane@mail.example", None, None),
            (None, "jane@mail.example", "x", "y"), (None, None, "x", "y"), (2, None, "x", "y"), (3, "", "x", "y"), (4, LONG + "a@b.cd", "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark string, spans string").repartition(3)
    got = privacy.sanitise(df, privacy.find_private(df))
    assert got.columns == df.columns
    texts_of = sorted(str(r["text"]) for r in got.collect())
    assert texts_of == sorted(str(t and t.replace("jane@mail.example", "<email>").replace("a@b.cd", "<email>")) for _, t, _, _ in rows)
    assert privacy.sanitise(edges, privacy.find_private(edges)).count() == edges.count()


def test_short_terms_and_contexts_of_one_document_disclose(spark):
    rng = random.Random(18)
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt".split()

    def some(n):
        return " ".join(rng.choices(filler, k=n))

    rows = [(i, some(12)) for i in range(300)]
    rows += [(300 + i, f"{some(6)} Lee calls +44 20 7946 0958 {some(4)}") for i in range(50)]
    rows += [(400, "; ".join(f"{some(9)} Silverfox writes jane@mail.example {some(9)}" for _ in range(10)))]
    rows += [(500, "Lee alone"), (501, some(5))]
    got = {r["doc_id"]: r["spans"] for r in privacy.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s["start"], s["kind"], s["end"]) for s in got[500]] in ([(0, 4, 3)], [(0, 5, 3)]) and not got[501]
    assert sum(rows[350][1][s["start"]:s["end"]] == "Silverfox" for s in got[400]) == 10


def test_contexts_take_whole_words():
    text = "z " + "x" * 300 + " é7 " + "名" * 200 + ",a@b.example,Ann " + "y" * 400 + " b"
    spans = privacy.base_spans(text)
    got = {t.decode() for _, _, t, _ in privacy.contexts(text, spans)}
    assert got == {"z", "x" * 300, "é7", "名" * 200, "ann", "y" * 400, "b"}
    one = privacy.contexts("k a@b.example l; m a@b.example l", [(2, 0, 13), (19, 0, 30)])
    assert len({c for _, c, _, _ in one}) == 2 and sum(first for _, _, t, first in one if t == b"l") == 1


def test_a_full_term_filter_changes_nothing(spark, docs):
    one = sorted(map(str, privacy.digest_spans(privacy.find_private(docs)).collect()))
    assert one == sorted(map(str, privacy.digest_spans(privacy.find_private(docs, filter_bits=64)).collect()))


def test_disclosure_by_hand(spark):
    """Every term of every text against the definition, from counts of whole documents."""
    rng = random.Random(21)
    filler = [f"w{k}" for k in range(30)]
    mails = [f"user{k}@mail.example" for k in range(6)]
    rows = []
    for i in range(240):
        words = rng.choices(filler, k=rng.randint(5, 40))
        if i % 3 == 0:
            who = rng.randrange(6)
            at = rng.randrange(len(words))
            words[at:at] = [*(["nick%d" % who] if rng.random() < 0.9 else []), mails[who], *(["Boss"] if rng.random() < 0.5 else [])]
        elif i % 7 == 0:
            words.append(f"nick{rng.randrange(6)}")
        rows.append((i, " ".join(words) + rng.choice(["", ".", "!"])))
    rows += [(900 + k, rows[0][1]) for k in range(4)]             # copies are one context
    pairs, n_e, n_t = {}, {}, {}
    for i, text in rows:
        words = re.sub("[!.]", " ", text.lower().replace("@mail.example", "@mail_example")).split()
        for t in {w for word in words for w in (word.replace("@mail_example", " mail example").split())}:
            n_t.setdefault(t, set()).add(i)
        for at, word in enumerate(words):
            if "@" in word:
                n_e.setdefault(word, set()).add(i)
                before, after = words[max(0, at - 8):at], words[at + 1:at + 9]
                for t in {*before, *after}:
                    pairs.setdefault((t, word), []).append((i, (tuple(before), tuple(after))))
    total, best = len(rows), {}
    for (t, e), found in pairs.items():
        if len({c for _, c in found}) >= privacy.SUPPORT:
            n_te = len({i for i, _ in found})
            score = np.log2(n_te * total / (len(n_t[t]) * len(n_e[e]))) / np.log2(total / len(n_e[e]))
            best[t] = max(best.get(t, -9), score)
    want = {t: 5 if x >= privacy.REMOVE else 4 for t, x in best.items() if x >= privacy.GENERALISE}
    assert want and set(want.values()) <= {4, 5}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["spans"]] for r in privacy.find_private(df).collect()}
    for i, text in rows:
        base = privacy.base_spans(text)
        terms = [(m.start(), want[m[0].lower()], m.end()) for m in re.finditer(r"[^\s!.@]+", text) if m[0].lower() in want]
        terms = [x for x in terms if not any(x[0] < e and s < x[2] for s, _, e in base)]
        assert got[i] == sorted(base + terms), (i, text)


# ------------------------------------------------------------------ 5 decontamination

def test_leaks_found(spark, edges, empty):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(3000)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(16, 50))) + "." for _ in range(40)]
    rows, planted = [], set()
    for i in range(400):
        words = rng.choices(vocabulary, k=rng.randint(20, 600))
        if i % 8 == 0:
            item = rng.randrange(40)
            own = items[item].split()
            if i % 16 == 0 and len(own) > 24:
                own[7] = "changed"                               # a light paraphrase
            at = rng.randint(0, len(words))
            words[at:at] = own
            planted.add((i, item))
        rows.append((i, " ".join(words)))
    bench = spark.createDataFrame(list(enumerate(items)) + [(90, None), (91, " ")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(
        spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert len(got & planted) >= 0.95 * len(planted) and len(got - planted) <= 1
    assert decontamination.find_leaks(edges, bench).count() == 0
    assert decontamination.find_leaks(empty, bench).count() == 0
    assert decontamination.find_leaks(edges, bench.limit(0)).count() == 0


def test_long_items_are_found(spark):
    rng = random.Random(16)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(3000)]
    items = [" ".join(rng.choices(vocabulary, k=n)) + "." for n in (65, 100, 129, 200, 500) for _ in range(4)]
    rows, planted = [], set()
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randint(20, 900))
        if i % 3 == 0:
            own = items[i // 3 % 20].split()
            if i % 2:
                own = [w for k, w in enumerate(own) if k % 13] if i % 4 == 1 else ["other" if k % 13 == 5 else w for k, w in enumerate(own)]
            at = rng.randint(0, len(words))
            words[at:at] = own
            planted.add((i, i // 3 % 20))
        rows.append((i, " ".join(words)))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert len(got & planted) >= 0.95 * len(planted) and len(got - planted) <= 1


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.longest_common(a, b) == table[-1][-1]


# ------------------------------------------------------------------ 6 compact windows

def test_windows_equal_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, least = int(rng.integers(1, 120)), int(rng.integers(2, 20))
        h = rng.integers(0, 60 if rng.random() < 0.5 else 10**9, n).astype(np.uint64)
        want = set()
        for c in range(n):
            if h[c]:
                lo = hi = c
                while lo > 0 and h[lo - 1] > h[c]:
                    lo -= 1
                while hi < n - 1 and h[hi + 1] >= h[c]:
                    hi += 1
                if hi - lo + 1 >= least:
                    want.add((c, lo, hi))
        assert set(zip(*(x.tolist() for x in compact_windows.compact_windows(h, least)), strict=True)) == want


def test_planted_passages_share_a_class(spark, edges, empty):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(5000)]
    rows = [rng.choices(words, k=rng.randint(20, 300)) for _ in range(150)]
    planted = []
    for _ in range(15):
        passage, own = rng.choices(words, k=rng.randint(52, 100)), rng.sample(range(150), rng.randint(2, 5))
        for d in own:
            at = rng.randint(0, len(rows[d]))
            rows[d][at:at] = passage
        planted.append((own, " ".join(passage)))
    text = [" ".join(r) for r in rows]
    df = spark.createDataFrame([*enumerate(text), (400, text[0]), (500, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in compact_windows.passage_classes(df).collect()}
    for own, passage in planted:
        assert len({got[d]["class_id"] for d in own if passage in text[d]}) <= 1
    inside = {d for own, _ in planted for d in own}
    assert not any(got[d]["n_links"] for d in range(150) if d not in inside)
    assert got[400]["class_id"] == got[0]["class_id"] and got[500]["n_links"] == 0
    assert compact_windows.passage_classes(edges).count() == edges.count()
    assert compact_windows.passage_classes(empty).count() == 0


def classes_of(spark, pairs, others=()):
    """class_id of each text of each pair of word lists, with other texts beside them."""
    rows = [" ".join(w) for pair in pairs for w in pair] + [" ".join(w) for w in others]
    got = compact_windows.passage_classes(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    at = {r["doc_id"]: r["class_id"] for r in got}
    return [(at[2 * k], at[2 * k + 1]) for k in range(len(pairs))]


def jaccard(a, b):
    a, b = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (a, b))
    return len(a & b) / len(a | b)


def test_replaced_words_keep_a_passage_together(spark):
    rng = random.Random(11)
    pairs = []
    for n in range(60, 101, 2):
        for edits in (1, 2):
            if edits == 2 and n < 96:
                continue
            a = [f"v{rng.randrange(10**9)}" for _ in range(n)]
            b = a.copy()
            for k in range(edits):
                b[n * (k + 1) // (edits + 1)] = f"new{k}x{n}"
            assert jaccard(a, b) >= 0.8
            pairs.append((a, b))
    got = classes_of(spark, pairs)
    assert sum(x == y for x, y in got) >= 0.9 * len(pairs) and len({x for x, _ in got}) == len(pairs)


def test_longest_stretch_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(200):
        equal = rng.random(int(rng.integers(1, 90))) < 0.9
        one, want = np.ones(len(equal), np.int64), 0
        for s in range(len(equal)):
            for e in range(s + 20, len(equal) + 1):
                m = int(equal[s:e].sum())
                if 10 * m >= 8 * (2 * (e - s) - m):
                    want = max(want, e - s)
        got = compact_windows.longest_stretch(9 * equal - 8, one, one, 20)
        assert (got[1] - got[0] if got else 0) == want


def test_passages_beside_a_frequent_line_meet(spark):
    rng = random.Random(12)

    def fresh(n):
        return [f"u{rng.randrange(10**9)}" for _ in range(n)]

    line = fresh(40)
    pairs, others = [], [line + fresh(60) for _ in range(240)]
    for _ in range(30):
        own = fresh(14)
        pairs.append(tuple(fresh(30) + line + own + fresh(30) for _ in range(2)))
    got = classes_of(spark, pairs, others)
    assert sum(x == y for x, y in got) >= 0.9 * len(pairs) and len({x for x, _ in got}) == len(pairs)


def test_passages_around_a_line_of_many_others_meet_wherever_they_stand(spark):
    rng = random.Random(21)

    def fresh(n):
        return [f"u{rng.randrange(10**9)}" for _ in range(n)]

    # neither first in the line's group nor beside each other
    line = fresh(44)
    sides = [(fresh(5), fresh(5)) for _ in range(100)]
    rows = [(k, fresh(30) + a + line + b + fresh(30)) for k, (a, b) in enumerate(sides) for _ in range(2)]
    rows += [(-1, fresh(30) + line + fresh(30)) for _ in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, " ".join(w)) for i, (_, w) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in compact_windows.passage_classes(df).collect()}
    own = [[i for i, (n, _) in enumerate(rows) if n == k] for k in range(100)]
    assert sum(got[x]["class_id"] == got[y]["class_id"] for x, y in own) >= 95
    assert len({r["class_id"] for r in got.values()}) >= 300 and not any(got[i]["n_links"] for i, (n, _) in enumerate(rows) if n < 0)


def test_inserted_and_deleted_words_keep_a_passage_together(spark):
    rng = random.Random(13)
    pairs = []
    for n in range(60, 100, 2):
        a = [f"i{rng.randrange(10**9)}" for _ in range(n)]
        pairs += [(a, [*a[:n // 2], f"in{n}", *a[n // 2:]])]
        a = [f"d{rng.randrange(10**9)}" for _ in range(n)]
        pairs += [(a, a[:n // 2] + a[n // 2 + 1:])]
        assert min(jaccard(*p) for p in pairs[-2:]) >= 0.8
    got = classes_of(spark, pairs)
    assert sum(x == y for x, y in got) >= 0.9 * len(pairs) and len({x for x, _ in got}) == len(pairs)


def test_similar_spans():
    rng = np.random.default_rng(5)

    def fresh(n):
        return rng.integers(0, 1 << 32, n).astype("<u4")

    def spans(x, y, shift=0, itself=False):
        return compact_windows.similar_spans(x, y, shift, itself)

    a = fresh(46)
    assert spans(a, a) == (0, 46, 0, 46, 46) and spans(a[:45], a[:45]) is None and spans(a, fresh(46)) is None
    assert spans(np.r_[fresh(1), a[1:]], a) == (0, 46, 0, 46, 45)                   # an edit at the end counts to its length
    b = np.r_[a[:23], fresh(9), a[23:]]
    assert spans(a, b) == (0, 46, 0, 55, 46) and spans(a, np.r_[a[:23], fresh(12), a[23:]]) is None
    long = fresh(300)
    got = spans(np.r_[fresh(80), long, fresh(50)], np.r_[fresh(20), long[:150], fresh(5), long[150:], fresh(200)])
    assert got[0] <= 80 and got[1] >= 380 and got[2] <= 20 and got[3] >= 325 and got[4] == 300
    assert got[4] >= 0.8 * (got[1] - got[0] + got[3] - got[2] - got[4])
    assert spans(np.r_[a[23:], a[:23]], a) == (0, 46, 0, 46, 46)                    # the Jaccard knows no order
    twice = np.r_[a, a, a[:20]]
    assert spans(twice, twice[46:], -46, True)[4] == 66 and spans(long, long[10:], 0, True) is None


# ------------------------------------------------------------------ 7 suffix dedup

def brute_removed(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                gone[k:k + 100] = [True] * 100
            seen.add(b[k:k + 100])
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def test_suffix_dedup_equals_brute_force(spark, docs, edges, empty):
    rng = random.Random(2)
    base = "".join(rng.choices("abcdé ", k=2000))
    rows = []
    for i in range(80):
        at = rng.randint(0, 1600)
        t = base[at:at + rng.randint(0, 400)] + "".join(rng.choices("xyz", k=rng.choice([0, 40, 200])))
        rows.append((i, rng.choice([t, t, t + t, "q" * rng.randint(0, 350), None])))
    rows += [(100 + k, rows[k][1]) for k in range(10)]
    for df, own in ((spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows),
                    (docs, list(texts(docs).items()))):
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
               for r in suffix_dedup.remove_repeats(df).collect()}
        assert got == brute_removed(own)
    found = suffix_dedup.remove_repeats(edges)
    assert found.count() == edges.count()
    assert {(r["n_removed"] == r["n_bytes"]) for r in found.filter("doc_id = 6").collect()} == {True}
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_cover_is_a_difference_set():
    assert {(a - b) % suffix_dedup.MODULUS for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.MODULUS))


# ------------------------------------------------------------------ 8 digest index

def test_digest_index_across_batches(spark, edges, empty, tmp_path):
    index = digest_index.DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    first = digest_index.dedup_batch(edges, index).collect()
    assert len(first) == edges.count()
    assert sum(r["kept"] for r in first) == 6                    # null and empty are one text, blank is one space
    known = index.read().count()
    # the same rows are the same batch, run again; under another name their texts are known
    assert sorted(map(str, digest_index.dedup_batch(edges, index).collect())) == sorted(map(str, first))
    assert not any(r["kept"] for r in digest_index.dedup_batch(edges, index, batch="later").collect())
    assert index.read().count() == known
    index.close()
    again = digest_index.DigestIndex(spark, str(tmp_path / "index"), buckets=4)       # the files outlive the session's table
    new = spark.createDataFrame([(50, "one two three four"), (51, "never seen")], "doc_id long, text string")
    assert {(r["doc_id"], r["kept"], r["keep_id"]) for r in digest_index.dedup_batch(new, again).collect()} == {
        (50, False, 1), (51, True, 51)}
    assert digest_index.dedup_batch(empty, again).count() == 0
    again.close()


def test_digest_index_batch_run_again_after_a_crash(spark, tmp_path, monkeypatch):
    old = spark.createDataFrame([(1, "known text"), (2, "known  text")], "doc_id long, text string")
    new = spark.createDataFrame([(10, "known text"), (11, "new text"), (12, "new\ttext"), (13, None)], "doc_id long, text string")
    index = digest_index.DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    digest_index.dedup_batch(old, index)
    with monkeypatch.context() as broken:
        def crash(self, df):
            raise RuntimeError("lost")
        broken.setattr(Work, "result", crash)
        with pytest.raises(RuntimeError):
            digest_index.dedup_batch(new, index)
    assert index.read().count() == 3                              # the append came through
    got = {r["doc_id"]: (r["kept"], r["keep_id"]) for r in digest_index.dedup_batch(new, index).collect()}
    assert got == {10: (False, 1), 11: (True, 11), 12: (False, 11), 13: (True, 13)}
    index.close()


def test_digest_index_gets_more_buckets(spark, tmp_path):
    path = str(tmp_path / "index")
    index = digest_index.DigestIndex(spark, path, buckets=2, bucket_rows=10)
    rows = spark.range(15).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    assert digest_index.dedup_batch(rows, index).filter("kept").count() == 15 and index.buckets == 2
    more = spark.range(10, 70).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    assert digest_index.dedup_batch(more, index).filter("kept").count() == 55 and index.buckets == 8
    assert index.read().count() == 70
    index.close()
    # opened again, the whole index is found, whatever a failed attempt left beside it
    (tmp_path / "index" / "b32").mkdir()
    again = digest_index.DigestIndex(spark, path, bucket_rows=10)
    assert again.buckets == 8 and again.read().count() == 70
    assert digest_index.dedup_batch(rows, again, batch="again").filter("kept").count() == 0
    again.close()


# ------------------------------------------------------------------ 9 token files

def test_coding_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        assert np.array_equal(token_files.unpack_block(token_files.pack_block([7, None], [n, 0], ranks))[2], ranks)


def test_chunks_encode_like_whole_texts():
    from tokenizers import Tokenizer
    rng = random.Random(1)
    parts = [*" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　ab'sé1.!-,", "  ", "'s", "<|endoftext|>", "\n\n ", "word.", "ver."]
    own = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(5000)]
    want = Tokenizer.from_file(TOKENIZER).encode_batch(own, add_special_tokens=False)
    encoder = token_files.ChunkEncoder(TOKENIZER)
    got = [x for _, _, data, offs in text_blocks(pa.array([*own, None]), 5000) for x in encoder(data, offs)]
    assert [x.tolist() for x in got] == [*(e.ids for e in want), []]


def test_encoder_without_room_for_chunks(monkeypatch, docs):
    own = pa.array([t for _, t in sorted(texts(docs).items())][:60])
    (_, _, data, offs), = text_blocks(own, 1 << 30)
    want = [x.tolist() for x in token_files.ChunkEncoder(TOKENIZER)(data, offs)]
    monkeypatch.setattr(token_files, "CACHE_CHUNKS", 300)
    encoder = token_files.ChunkEncoder(TOKENIZER)
    got = [x.tolist() for _, _, data, offs in text_blocks(own, 2000) for x in encoder(data, offs)]
    assert got == want and len(encoder) <= 300


def test_encoder_holds_few_bytes_a_chunk_and_encodes_it_once(monkeypatch):
    import tracemalloc
    own = pa.array([" ".join(f"w{a}x{b}, {'ab'[b % 2] * (a % 9 + 1)}q" for b in range(40)) for a in range(1000)])
    encoder = token_files.ChunkEncoder(TOKENIZER)
    tracemalloc.start()
    want = [x.tolist() for _, _, data, offs in text_blocks(own, 100_000) for x in encoder(data, offs)]
    del want[10:]
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(encoder) > 40_000 and held < 80 * len(encoder)
    monkeypatch.setattr(encoder, "_learn", None)                  # every chunk is known by now
    assert [x.tolist() for _, _, data, offs in text_blocks(own, 100_000) for x in encoder(data, offs)][:10] == want


def test_token_files_round_trip(spark, docs, edges, empty, tmp_path):
    from tokenizers import Tokenizer
    token_files.write_token_files(docs, str(tmp_path / "t"), TOKENIZER)
    got = {r["doc_id"]: tuple(r) for r in token_files.read_token_files(spark, str(tmp_path / "t")).collect()}
    own, start = sorted(texts(docs).items()), 0
    for (i, _), e in zip(own, Tokenizer.from_file(TOKENIZER).encode_batch([t for _, t in own], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        assert got[i] == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    token_files.write_token_files(edges, str(tmp_path / "e"), TOKENIZER)
    back = token_files.read_token_files(spark, str(tmp_path / "e"), with_ids=True).orderBy("start").collect()
    assert len(back) == edges.count() and back[0]["doc_id"] is None and all(r["ids"][-1] == 2 for r in back)
    token_files.write_token_files(empty, str(tmp_path / "n"), TOKENIZER)
    assert token_files.read_token_files(spark, str(tmp_path / "n")).count() == 0


# ------------------------------------------------------------------ 10 simhash

def brute_fingerprint(t):
    w = t.encode().lower().split()
    shingles = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles)) if shingles else 0


def brute_components(fps):
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(fps)
    f = np.array([fps[i] for i in ids], np.uint64)
    for a, b in zip(*np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 2), strict=True):
        x, y = find(ids[a]), find(ids[b])
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(docs, edges, empty):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    want = {i: brute_fingerprint(t) for i, t in texts(docs).items()}
    assert {i: r["fp"] & (2**64 - 1) for i, r in got.items()} == want
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(want)
    found = simhash.near_duplicates(edges).collect()
    assert len(found) == edges.count()
    assert {r["fp"] for r in found if r["doc_id"] in (2, 3, 4)} == {0}
    assert simhash.near_duplicates(empty).count() == 0


def test_tiles_lose_no_link(spark):
    rng = random.Random(9)
    own = [rng.getrandbits(64) for _ in range(100)]
    for _ in range(800):
        x = rng.choice(own)
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        own.append(x)
    fps = dict(enumerate(sorted(set(own))))
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps.values()], "fp long")
    with Work(spark, "test") as work:
        roots = connected_components(work, work.cut(simhash.links(work, df, 2, tile=32), "links")).collect()
        got = {int(np.int64(r["node"]).astype(np.uint64)): r["root"] for r in roots}
    classes = {}
    for i, root in brute_components(fps).items():
        classes.setdefault(root, set()).add(got.get(fps[i], ("single", fps[i])))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_latent_space_is_fitted_on_all_documents(spark, monkeypatch):
    # more than twice as many documents as the fit used to draw
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(30)]
    texts = [" ".join(vocabulary[k] for k in rng.integers(0, 30, 3)) for _ in range(9000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(vocabulary))], "item_id long, text string")
    seen = {}

    def keep(rows, items, weights, basis):
        seen.update(items=items, weights=weights, basis=basis)
        return rows.limit(0).selectExpr("doc_id", "mark", "doc_id item_id", "0d cosine", "0d lcs_ratio", "false answer_found")

    monkeypatch.setattr(decontamination, "_leaks", keep)
    monkeypatch.setattr(decontamination, "ITEM_SHARE", 0.0)
    assert decontamination.find_leaks(docs, bench, rank=30).count() == 0
    items, weights, basis = (seen[k] for k in ("items", "weights", "basis"))
    a = np.zeros((9000, 30))
    for k, t in enumerate(texts):
        np.add.at(a[k], items.terms(decontamination._words_of(t)), 1)
    expected = np.log((27000 / 16 + 2) / (a.sum(0) + 1))
    assert np.allclose(weights[:-1], np.maximum(expected, 0.05), rtol=1e-5)
    # both rounds by hand, over all documents
    a *= weights[:-1]
    drawn = np.linalg.qr(np.random.default_rng(decontamination.SEED).standard_normal((30, 30)))[0]
    for _ in range(2):
        drawn = np.linalg.qr(a.T @ (a @ drawn))[0]
    assert np.abs(np.abs((drawn * basis).sum(0)) - 1).max() < 1e-3


def test_frequent_and_rare_terms_add_up_like_single_words(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(decontamination, "FREQUENT", 5)
    monkeypatch.setattr(decontamination, "GROUPS", 3)
    group = np.sort(rng.choice([0, 1, 2, 4, 5, 6, 9], 300))        # 3, 7, 8 and 10 have no words
    term = rng.choice(21, 300, p=np.append(np.full(20, 0.03), 0.4))  # 20: outside the space
    vectors, weights = rng.standard_normal((20, 4)).astype(np.float32), rng.random(21).astype(np.float32)
    sums = np.zeros((11, 4))
    known = term < 20
    np.add.at(sums, group[known], vectors[term[known]])
    space = decontamination.TermVectors(vectors, weights)
    assert np.allclose(space.sums(group, term, 11), sums, atol=1e-5)
    total, expected = np.ones((20, 4)), np.ones((20, 4))
    values = rng.standard_normal((11, 4)).astype(np.float32)
    np.add.at(expected, term[known], values[group[known]])
    space.add_groups(group, term, values, total)
    assert np.allclose(total, expected, atol=1e-5)
    assert space.sums(group[:0], term[:0], 0).shape == (0, 4)


def test_presence_drops_only_rows_without_enough_of_an_item(monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(60)]
    items = decontamination.Items([{"item_id": k, "text": " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))} for k in range(20)])
    texts = [rng.choices(vocabulary, k=rng.randint(0, 60)) for _ in range(50)]
    words = [decontamination._words_of(" ".join(t)) for t in texts]
    row, term = np.repeat(np.arange(50), [len(w) for w in words]), items.terms(np.concatenate(words))
    r, j = (x.ravel() for x in np.meshgrid(np.arange(50), np.arange(20)))
    enough = np.array([np.isin(items.words[b], words[a]).sum() >= decontamination.LCS_MAYBE * len(items.words[b]) for a, b in zip(r, j)])
    monkeypatch.setattr(decontamination, "PAIRS", 7)
    assert (decontamination.Presence(items, row, term).held(r, j) == enough).all()
    monkeypatch.setattr(decontamination, "MARKS", 256)              # marks are shared: more may seem held, never less
    assert decontamination.Presence(items, row, term).held(r, j)[enough].all()


def test_two_windows_are_linked_once():
    # three windows of one hash, alike on all sides: the group and each neighbourhood link them
    spans = np.array([[10, 0, 60, 0, 1, 2, 3, 4]] * 3)
    got = compact_windows._pairs(np.full(3, 1 << 63, np.uint64), np.arange(3), np.zeros(3, np.int32), spans).to_pylist()
    assert [(r["a"], r["b"]) for r in got if r["hash"] is None] == [(0, 1), (0, 2), (1, 2)]
    assert sum(r["hash"] is not None for r in got) == 3


def test_texts_that_few_functions_link_give_no_candidates(spark):
    rng = random.Random(12)
    rows, functions = [], {}
    for a in range(40):
        for k in rng.sample(range(8), rng.randint(1, 8)):
            lo = rng.randint(0, 20)
            rows.append((a, a + rng.randint(1, 2), 0, 5, 0, k, lo, lo + 60, 0, 99, 0, 99))
            functions.setdefault(rows[-1][:2], set()).add(k)
    later = rows[::3]
    ddl = ", ".join(f"{c} {'int' if c == 'k' else 'long'}" for c in compact_windows._LINK.names)
    links, more, rest = (spark.createDataFrame(x, ddl) for x in (rows, later, [r for k, r in enumerate(rows) if k % 3]))
    enough = {p for p, k in functions.items() if len(k) >= compact_windows.AGREE}
    assert 0 < len(enough) < len(functions)
    with Work(spark, "test") as work:
        kept = compact_windows.agreeing(work, links, "one")
        assert {(r["a"], r["b"]) for r in kept.collect()} == enough
        assert sorted(compact_windows.candidates(kept).collect()) == sorted(compact_windows.candidates(links).collect())
        kept = compact_windows.agreeing(work, rest, "two", more)
        assert {(r["a"], r["b"]) for r in kept.collect()} == enough & {r[:2] for r in later}


def test_could_pass_equals_brute_force():
    rng = np.random.default_rng(4)
    n, least, found = 260, compact_windows.TOKENS, 0
    for share in (0.75, 0.8, 0.85, 0.9):
        token = rng.integers(1, 1 << 60, n).astype(np.uint64)
        token[[70, 71, 150]] = 0
        hit = rng.random(n) < share
        want = set()
        for end in range(least, n + 1):
            for start in range(end - least + 1):
                if (token[start:end] > 0).all() and 9 * hit[start:end].sum() >= 4 * (end - start + least):
                    want.add(end - 1)
        assert set(compact_windows.could_pass(hit, token).tolist()) == want
        found += len(want)
    assert found
    assert not len(compact_windows.could_pass(np.ones(least - 1, bool), np.ones(least - 1, np.uint64)))


def test_windows_with_nothing_alike_beside_them_are_compared(spark):
    # texts 0 and 1 hold a passage, 2 to 5 a line of it only; all have a window of one hash under five functions
    line, rest = [f"l{i}" for i in range(12)], [f"p{i}" for i in range(48)]
    texts = [rest[:20] + line + rest[20:]] * 2 + [[f"t{d}_{i}" for i in range(20)] + line + [f"t{d}_{i}" for i in range(20, 48)]
                                                  for d in range(2, 6)]
    texts = [[f"own{d}"] + t for d, t in enumerate(texts)]
    data = [" ".join(t).encode() for t in texts]
    blocks = spark.createDataFrame([(b, list(range(3 * b, 3 * b + 3)), [0] * 3, [len(x) for x in data[3 * b:3 * b + 3]],
                                     bytearray(b"".join(data[3 * b:3 * b + 3]))) for b in range(2)],
                                   "block long, doc_ids array<long>, marks_of array<long>, lens array<long>, text binary")
    start = [len(texts[0]) * (d % 3) for d in range(6)]
    left = spark.createDataFrame([(d // 3, start[d], start[d] + 23, k, start[d], start[d] + 56, 100 + k) for d in range(6) for k in range(5)],
                                 "a long, a_text long, diagonal long, k int, lo long, hi long, hash long")
    links = spark.createDataFrame([], ", ".join(f"{c} {'int' if c == 'k' else 'long'}" for c in compact_windows._LINK.names))
    places = spark.createDataFrame([], "block long, text long, doc_id long, mark long")
    roots = spark.createDataFrame([], "node long, root long")
    laid = SimpleNamespace(blocks=blocks, total=sum(map(len, data)))
    with Work(spark, "test") as work:
        got = compact_windows.apart(work, laid, links, left, places, roots).collect()
    assert {(r["a"], r["a_text"], r["b"], r["b_text"]) for r in got} == {(0, 0, 0, start[1])}
    assert sorted(r["k"] for r in got) == [0, 1, 2, 3, 4]
    assert {(r["diagonal"], r["lo"], r["hi"]) for r in got} == {(61, 0, 56)}
