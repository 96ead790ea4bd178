"""Token counts, quality, licences, secrets and personal data."""

import hashlib
import math
import re
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flightlake.llm import licenses, pii, quality, secrets, tokens
from flightlake.llm.queries import PII_KEY

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TRICKY = ["a<|startoftext|>b <|endoftext|>", "<|StartOfText|>", "don't I'll we've IT'S", "é ́e İstanbul K ſ", "a b c　d\x1ce\x85f",
          "日本語 テスト １２３ ½ Ⅷ", "😀👩‍👩‍👧 x", "\x00\x01 a\x0bb\x0cc", "ǅ ß ﬁ Å Ω Σς ΑΣ", "'S'T x'll'd 's", "x" * 3000]


def test_token_counts_equal_the_library(spark, docs_of, small_docs, odd):
    library = Tokenizer.from_file(VOCABULARY)
    for docs in (small_docs, docs_of(enumerate(TRICKY)), odd):
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        counts = [len(e.ids) for e in library.encode_batch([t for _, t in rows], add_special_tokens=False)]
        expected = sorted((str(i), len(t.encode()), n, n > 2048) for (i, t), n in zip(rows, counts))
        got = tokens.count_tokens(docs, VOCABULARY, 2048)
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == expected
    assert tokens.count_tokens(docs_of([]), VOCABULARY, 2048).count() == 0


def test_whole_tokens_are_proven(spark):
    proof = tokens.prove_whole_tokens(open(VOCABULARY, encoding="utf-8").read())
    library = Tokenizer.from_file(VOCABULARY)
    for word in ("the", "house", "é"):
        level = tokens._byte_level(word)
        assert (level in proof.whole) == (len(library.encode(word, add_special_tokens=False).ids) == 1)


def test_blocks_cut_at_white_space():
    text = b" ".join(b"w%d" % i for i in range(5000)) + b"y" * 3000 + b" z"
    parts = list(tokens.blocks(text, 1000))
    assert b"".join(parts) == text and [x for p in parts for x in p.split()] == text.split()


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    weights = quality.fit(docs, labels)
    rows = quality.score_quality(docs, weights).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert sum(r.predicted for r in held if r.quality == 1) >= 0.99 * sum(r.quality for r in held)
    kept = quality.keep_good(docs, weights)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in rows if r.predicted} == {r.doc_id for r in kept.collect()} & {r.doc_id for r in rows}


def test_quality_score_is_the_sparse_dot_product(spark, docs_of):
    weights = quality.np.linspace(-1, 1, quality.BUCKETS + 1).astype("float32")
    text = "Some words, SOME words!! again again"
    (where, value), = quality.features(pa.array([text.encode()], pa.binary()))
    margin = sum(float(weights[i]) * float(v) for i, v in zip(where, value)) + float(weights[-1])
    row = quality.score_quality(docs_of([(1, text)]), weights).first()
    assert row.score == pytest.approx(1 / (1 + quality.np.exp(-margin)), abs=1e-5)


def test_quality_odd_rows(spark, odd, docs_of):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    weights = quality.fit(odd, labels)
    rows = quality.score_quality(odd, weights).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    none = quality.fit(odd, labels.where("false"))
    assert {r.score for r in quality.score_quality(odd, none).collect()} == {0.5}
    assert quality.keep_good(docs_of([]), none).count() == 0


UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    places = sorted((i, name) for phrase, name in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({n for _, n in places})))


def test_license_base_equals_brute_force(spark, docs_of, small_docs, odd):
    made = docs_of([(1, "Under the MIT License under the MIT license. CC-BY-NC 4.0; Apache License, Version 2.0"), (2, "é CC BY NC K-under ſ"), (3, "cc by\nnc cc by nc")])
    for docs in (made, small_docs, odd):
        found = licenses.scan_licenses(docs).collect()
        expected = sorted(((r.doc_id, *base_licenses(r.text)) for r in docs.collect()), key=str)
        assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=str) == expected
        assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1 for r in found)
    assert licenses.scan_licenses(docs_of([])).count() == 0


def test_license_rules_resolve_overlaps(docs_of):
    texts = {
        1: ("This is under the GNU General Public License version 2 or any later version.", "gpl-2-or-later"),
        2: ("Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc-4.0"),
        3: ("Licensed under the 3-Clause BSD License", "bsd-3-clause"),
        4: ("SPDX-License-Identifier: MIT", "mit"),
        5: ("licensed under terms to be named", "unknown"),
        6: ("nothing of the kind", ""),
        7: ("GNU Lesser General Public License v2.1 and Mozilla Public License 2.0", "lgpl-2.1,mpl-2.0"),
    }
    found = {r.doc_id: r.labels for r in licenses.scan_licenses(docs_of([(i, t) for i, (t, _) in texts.items()])).collect()}
    assert found == {i: want for i, (_, want) in texts.items()}
    assert len(licenses.rules()) >= 300


def forms(parsed):
    """All texts that a parsed pattern of literals, options, branches and small classes matches."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            each = [chr(arg)]
        elif name == "IN":
            each = [chr(v) if str(o) == "LITERAL" else chr(v[0]) for o, v in arg]
        elif name == "BRANCH":
            each = [f for branch in arg[1] for f in forms(branch)]
        elif name == "SUBPATTERN":
            each = forms(arg[3])
        else:
            assert name == "MAX_REPEAT", name
            least, most, inner = arg
            each = ([""] if least == 0 else []) + (forms(inner) if most else [])
        out = [a + b for a in out for b in each]
    return out


def test_every_form_of_a_rule_holds_its_keyword():
    for rule in licenses.rules():
        for form in set(forms(re._parser.parse(rule.pattern))):
            assert rule.gate in f" {form} ", (rule, form)


def resolve(spans):
    """``(start, stop, priority)``: the strongest first, those that cross or equal one kept go, then those inside another."""
    kept = []
    for a, b, p in sorted(spans, key=lambda s: (-s[2], s[0] - s[1], s[0])):
        if not any((a, b) == (c, d) or (max(a, c) < min(b, d) and not (a <= c and d <= b) and not (c <= a and b <= d)) for c, d, _ in kept):
            kept.append((a, b, p))
    return sorted(s for s in kept if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in kept))


def test_resolution_equals_the_plain_rule(spark):
    import random
    rng = random.Random(6)
    cases = []
    for i in range(300):
        spans = {(a, a + rng.randrange(1, 9), rng.randrange(1, 4)) for a in (rng.randrange(30) for _ in range(rng.randrange(12)))}
        cases.append((i, [(a, -b, -p, "x", 1.0) for a, b, p in spans]))
    rows = spark.createDataFrame(cases, f"id long, m array<{licenses._SPAN}>").select("id", licenses._resolved(F.col("m")).alias("m")).collect()
    got = {r.id: [(m.start, -m.minus_stop, -m.minus_priority) for m in r.m] for r in rows}
    assert got == {i: resolve([(a, -b, -p) for a, b, p, _, _ in m]) for i, m in cases}


def test_license_matches_the_prefilter_and_the_sweep_once_lost(docs_of):
    texts = ["released under gpl2 or later", "lgpl3 or later applies", "beerware license", "GPLv3plus", "dedicates this work to the public domain"]
    found = {r.doc_id: r.labels for r in licenses.scan_licenses(docs_of(enumerate(texts))).collect()}
    assert found == {0: "gpl-2-or-later", 1: "lgpl-3-or-later", 2: "beerware", 3: "gpl-3-or-later", 4: "public-domain"}
    made = [licenses.Rule(*r, 1.0) for r in (("weak", "aa", "aa bb cc dd ee", 1), ("strong", "bb", "bb cc", 9), ("third", "ee", "ee ff", 5))]
    assert licenses.scan_licenses(docs_of([(1, "aa bb cc dd ee ff")]), ruleset=made).first().labels == "strong,third"
    assert licenses.scan_licenses(docs_of([(1, "aa bb cc dd ee gg")]), ruleset=made).first().labels == "weak"


def brute_secrets(text):
    found = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    names = ("assign", "access", "hex")
    return [sum(f[1] == k for f in found) for k in range(3)], ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secret_base_spans_equal_brute_force(spark, docs_of, odd):
    made = docs_of([(1, 'é PASSWORD = "abc12" token: abcdef api_key=0123456789abcdef01234567 AKIA' + "A1" * 8), (2, "ſecret=abcdefgh api_Key='zz.zz.zz'"),
                    (3, "Aabcdef0123456789abcdef0123f " + "f" * 23), (4, "apikey  :  aaaaaaa token==x token=======")])
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for table in (made, docs.select("doc_id", "text"), odd):
        expected = {}
        for r in table.collect():
            counts, spans = brute_secrets(r.text or "")
            expected.setdefault(r.doc_id, []).append((*counts, hashlib.sha256(spans.encode()).hexdigest()))
        found = secrets.digest(secrets.find_secrets(table)).collect()
        for r in found:
            assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) in expected[r.doc_id]
        assert len(found) == sum(map(len, expected.values()))
    assert secrets.find_secrets(docs_of([])).count() == 0


def test_secret_automata_score_formats(spark, docs_of):
    import random
    rng = random.Random(3)
    token = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f"token = {token()} and plain antidisestablishmentarianisms words") for i in range(200)]
    rows += [(1000 + i, " ".join("".join(rng.choice("etaoinshr") for _ in range(18)) for _ in range(5))) for i in range(200)]
    hidden = token().upper()
    found = {r.doc_id: r for r in secrets.find_secrets(docs_of([*rows, (5000, f"see {hidden[:20].lower()} here")])).collect()}
    assert "format:4:24" in found[5000].spans
    assert sum("format" in found[1000 + i].spans for i in range(200)) <= 2
    assert all(found[i].base_spans in found[i].spans or set(found[i].base_spans.split(",")) <= set(found[i].spans.split(",")) for i in range(200))


def plain_candidates(text, base):
    """Every maximal stretch of credential characters that no base span covers, character by character."""
    inside = {i for _, a, b in base for i in range(a, b)}
    free = "".join(c if i not in inside and re.match("[A-Za-z0-9+/_=-]", c) else "\0" for i, c in enumerate(text))
    return [m.span() for m in re.finditer("[^\0]{6,}", free)]


def test_secret_candidates_are_all_runs_outside_base_spans():
    import random
    rng = random.Random(4)
    pieces = ["AKIA" + "Q7" * 9, "0123456789abcdef" * 2, "token=abc/def.ghi", "my_password: x", "PASSWD='zzzzzz'", " ", "é", "abc", "Longer_word-12", "=", ".", "AKIA"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        base = secrets.base_spans(text)
        assert list(secrets.candidates(text, base)) == plain_candidates(text, base), text


def test_every_candidate_is_scored_by_the_plain_likelihood(spark, docs_of):
    import random
    rng = random.Random(9)
    short = lambda n: "".join(rng.choice("0123456789") if i % 2 else rng.choice("QWRTZXCVB") for i in range(n))
    rows = [(i, f"password={short(10)} then plainly{'abcdefghij'[i % 10]}written sentence number words") for i in range(300)]
    rows += [(1000, f"see {short(10)} here"), (1001, None), (1002, ""), (1003, f"{short(10)}AKIA" + "B2" * 9)]
    docs = docs_of(rows)
    automata = secrets.learn(secrets.samples(docs))
    ready = {k: (secrets.Automaton(m), least, most) for k, (m, least, most) in automata.items()}

    def plain(automaton, word):
        state, total = 0, 0.0
        for symbol in [*word, "$"]:
            step = automaton.moves[state].get(symbol, [0, 0])
            total += math.log((step[1] + 0.5) / (automaton.total(state) + 4))
            state = step[0]
        return total / (len(word) + 1)

    found = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    for i, text in rows:
        base, want, best = secrets.base_spans(text or ""), [], None
        for a, b in plain_candidates(text or "", base):
            word = secrets.classes(text[a:b])
            kinds = [(plain(g, word), least, most) for k, (g, least, most) in ready.items() if k not in secrets.ORDINARY]
            score = max(r for r, _, _ in kinds) - max(plain(ready[k][0], word) for k in secrets.ORDINARY if k in ready)
            best = score if best is None else max(best, score)
            want += [("format", a, b)] if score >= secrets.MARGIN and any(x <= r <= y for r, x, y in kinds) else []
        assert found[i].spans == secrets.joined(sorted(base + want, key=secrets._place)) and found[i].best_format == pytest.approx(best)
    assert found[1000].spans == "format:4:14"
    assert not any("format" in found[i].spans for i in range(300))


def test_a_long_text_of_spans_and_candidates_takes_linear_time(spark, docs_of):
    import time
    text = " ".join(f"token=abc{i:06d} LongWord{i:06d}x" for i in range(100_000))
    start = time.time()
    assert secrets.find_secrets(docs_of([(1, text)])).first().n_assign == 100_000
    assert time.time() - start < 60


def test_whole_strings_are_counted_and_samples_are_the_smallest(docs_of):
    words = ["l" * 70 + "d" * n for n in range(1, 30)]
    grown = secrets.Automaton.tree(words).infer().recount(words)
    assert sum(each.get("$", [0, 0])[1] for each in grown.moves) == len(words)
    assert sum(n for each in grown.moves for _, n in each.values()) == sum(len(w) + 1 for w in words)
    values = {f"Word{i:05d}" for i in range(500)}
    docs = docs_of([(i, f"{v} {v}") for i, v in enumerate(sorted(values))])
    kept = {r.value for r in secrets.samples(docs, bound=5).collect()}
    assert set(sorted(values, key=secrets._checksum)[:5]) <= kept < values


def test_state_merging_learns_a_small_automaton():
    words = ["ab" * n for n in range(1, 40)] * 5
    grown = secrets.Automaton.tree(words).infer()
    assert len(grown.moves) < 12
    assert grown.rate("abababab") > grown.rate("bbbb")


PERSONAL = ("Write to Jo.81@mail7.example.com or JO.81@MAIL7.EXAMPLE.COM, call +1 (124) 555-4766, pay 4111 1111 1111 1111, from 10.2.33.144. "
            "Mrs. Anna Smith met Mr. Smith; Smith left. г-жа Иванова. CC BY 4.0.")


def test_surrogates_keep_type_format_and_identity(docs_of):
    rows = pii.pseudonymise(docs_of([(1, PERSONAL), (2, "again jo.81@mail7.example.com"), (3, "nothing here")]), PII_KEY).collect()
    text = {r.doc_id: r.text for r in rows}
    for gone in ("81@mail7", "555-4766", "4111 1111", "10.2.33.144", "Anna", "Smith", "Иванова"):
        assert gone.lower() not in text[1].lower()
    mails = re.findall(r"[\w.]+@[\w.]+\w", text[1])
    assert mails[0].lower() == mails[1].lower() and mails[1].isupper() and mails[0].lower() in text[2]
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", text[1]) and re.search(r"\d{4} \d{4} \d{4} \d{4}", text[1])
    card = re.sub(r"\D", "", re.search(r"\d{4} \d{4} \d{4} \d{4}", text[1])[0])
    assert pii._luhn(card) == 0
    names = re.search(r"Mrs\. (\w+) (\w+) met Mr\. (\w+); (\w+) left\. г-жа (\w+)\.", text[1])
    assert names[2] == names[3] == names[4] and pii.script_of(names[5]) == "cyrillic"
    assert text[1].endswith("CC BY 4.0.") and text[3] == "nothing here"


def test_surrogates_stay_distinct_when_they_collide(spark, docs_of, monkeypatch):
    n = 300  # one-digit parts leave 9 ** 4 addresses, two-letter hosts few more: draws collide
    rows = [(i, f"{i % 9 + 1}.{i // 9 % 9 + 1}.{i // 81 + 1}.7") for i in range(n)]
    found = {r.doc_id: r.text for r in pii.pseudonymise(docs_of(rows), PII_KEY).collect()}
    assert len(set(found.values())) == n and not set(found.values()) & {t for _, t in rows}


def test_surrogates_do_not_run_out(docs_of):
    """More than half of all one-digit addresses: no assignment of that length exists."""
    rows = [(i, f"{i % 9 + 1}.{i // 9 % 9 + 1}.{i // 81 % 9 + 1}.{i // 729 + 1}") for i in range(4500)] + [(9000 + i, f"{c}@x.org") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    found = {r.doc_id: r.text for r in pii.pseudonymise(docs_of(rows), PII_KEY).collect()}
    assert len(set(found.values())) == len(rows) and not set(found.values()) & {t for _, t in rows}


def test_titles_without_gender_keep_coreference(docs_of):
    texts = [(1, "Dr. Anna Smith called. Mrs. Anna Smith left. Anna went home."), (2, "Dr. Anna Smith spoke.")]
    text = {r.doc_id: r.text for r in pii.pseudonymise(docs_of(texts), PII_KEY).collect()}
    m = re.fullmatch(r"Dr\. (\w+) (\w+) called\. Mrs\. (\w+) (\w+) left\. (\w+) went home\.", text[1])
    assert m[1] == m[3] == m[5] != "Anna" and m[2] == m[4] != "Smith"
    assert m[1].endswith(pii.GIVEN["latin"]["f"]) and "Anna" not in text[2]


@pytest.mark.parametrize("text, kind, kept", [
    ("pay DE89 3704 0044 0532 0130 00 now", "iban", r"pay DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d now"),
    ("GB29NWBK60161331926819.", "iban", r"GB\d\d[A-Z]{4}\d{14}\."),
    ("host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 up", "ip6", r"host ([0-9a-f]{4}:){7}[0-9a-f]{4} up"),
    ("via fe80::1:2A, then", "ip6", r"via [0-9A-F]{4}::[0-9A-F]:[0-9A-F]{2}, then"),
    ("call +49 30 1234567 today", "phone", r"call \+\d\d \d\d \d{7} today"),
    ("call +33 1 23 45 67 89 today", "phone", r"call \+\d\d \d \d\d \d\d \d\d \d\d today"),
])
def test_more_forms_of_personal_data(docs_of, text, kind, kept):
    row = pii.pseudonymise(docs_of([(1, text)]), PII_KEY).first()
    assert row.kinds == kind and row.n_entities == 1 and row.text != text and re.fullmatch(kept, row.text)
    if kind == "iban":
        assert pii._iban_rest(re.search(r"[A-Z]{2}\d\d[A-Z0-9 ]*\d", row.text)[0].replace(" ", "")) == 1


def test_what_only_looks_like_personal_data():
    for text in ("at 12:30:45 or 1:2", "std::cout << a::b", "XX00 ABCD EFGH", "::", "+1 2"):
        assert pii.entities(text) == []


def test_personal_data_odd_rows(odd, docs_of):
    before = sorted((str(r.doc_id), r.text) for r in odd.where("text is not null").collect())
    rows = pii.pseudonymise(odd, PII_KEY).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows if r.text is not None) == before
    assert sum(r.text is None for r in rows) == 2 and all(r.n_entities == 0 for r in rows)
    assert pii.pseudonymise(docs_of([]), PII_KEY).count() == 0
