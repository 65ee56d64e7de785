import hashlib
import re
import time

import numpy as np

from samples import ODD, SF, docs_of, none, odd  # noqa: F401

from themewell.llm import secret_scan


def plain(text):
    found = []
    for m in re.finditer(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
                         r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):  # fmt: skip
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_known_forms_of_the_table(spark):
    from themewell.llm import queries

    got = {r.doc_id: r for r in queries.op1_randomness_battery(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, r = plain(d.text or ""), got[d.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        shown = secret_scan.shown(want)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == [s for s in shown.split(",") if s]


def test_known_forms_of_hard_texts():
    signs = ["token", "SECRET", "api_key", "apikey", "passwd", "password", ":", "=", " ", '"', "'", "abcdef0123456789", "AKIA",
             "ABCD1234", "é", "😀", "ſecret", "toKen", ".", "/", "x", "0" * 20]
    rng = np.random.default_rng(0)
    for _ in range(4000):
        text = "".join(rng.choice(signs, rng.integers(0, 12)))
        assert secret_scan.known_spans(text) == plain(text), text


def test_battery_tells_random_symbols_from_words():
    rng = np.random.default_rng(1)
    for _, alphabet in secret_scan.ENCODINGS:
        chances = [secret_scan.combined("".join(rng.choice(list(alphabet), 48))) for _ in range(400)]
        assert np.mean(np.array(chances) < 0.01) < 0.05
    assert secret_scan.combined("thequickbrownfoxjumpsoverthelazydogagainandagain") < 1e-6
    assert secret_scan.combined("a" * 40) < 1e-9 and secret_scan.combined("0f" * 20) < 1e-6
    assert secret_scan.combined("1234567890" * 3) == 0.0
    alternating = np.array([0, 15] * 30)
    assert secret_scan.runs(alternating, 16) < 1e-6 and secret_scan.serial(alternating, 16) < 1e-6
    assert secret_scan.uniformity(np.arange(64) % 16, 16) > 0.5


def test_random_keys_are_added_and_words_are_not(docs_of):
    rng = np.random.default_rng(2)
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    words = ["water", "Tree", "under", "the", "lightning", "of", "houses", "and", "wandering", "mountain", "river", "stone"]
    rows, keys = [], {}
    for i in range(120):
        text = " ".join(rng.choice(words, 80))
        if i % 2:
            text += " " + "".join(rng.choice(words, 7))  # long, but made of words
        else:
            keys[i] = "".join(rng.choice(alphabet, 40))
            text += " see " + keys[i] + " there"
        rows.append((i, text, "en", "a"))
    got = {r.doc_id: r for r in secret_scan.scan(docs_of(rows)).collect()}
    hits = {}
    for i, text, *_ in rows:
        for s in filter(None, got[i].spans.split(",")):
            kind, a, b = s.split(":")
            hits.setdefault(i, []).append((kind, text[int(a) : int(b)]))
    right = sum(hits.get(i) == [("random", k)] for i, k in keys.items())
    assert right >= 55
    assert sum(len(v) for i, v in hits.items() if i not in keys) <= 0.1 * right


def test_thresholds_control_false_ones():
    # 100 candidates as random as can be, and 40 low ones where decoys lie as well.
    t = {(2, 60): 100, (2, 10): 40}
    assert secret_scan.thresholds(t, {(2, 10): 800})[2] == 11
    assert secret_scan.thresholds({(2, 60): 1}, {})[2] == secret_scan.BINS  # too few to tell
    assert secret_scan.thresholds({}, {}) == [secret_scan.BINS] * len(secret_scan.LENGTHS)


def test_odd_rows(odd, none):
    rows = secret_scan.scan(odd).collect()
    assert len(rows) == len(ODD) and {r.spans for r in rows} == {""}
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert secret_scan.scan(none).collect() == []


def test_keys_in_paths_and_urls_are_tested_alone(docs_of):
    url = "https://api.host.io/v1/my-app/9f8Ksd83jfKLs92kfjD83kdQ0aZ"
    assert "9f8Ksd83jfKLs92kfjD83kdQ0aZ" in [url[a:b] for a, b in secret_scan.candidates(url, [])]
    assert all(secret_scan.infer(url[a:b]) for a, b in secret_scan.candidates(url, []))
    rng = np.random.default_rng(7)
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    words = ["water", "Tree", "under", "the", "lightning", "of", "houses", "and", "wandering", "mountain", "river", "stone"]
    heads = ["https://api.host.io/v1/my-app/", "/usr/local/share/data_files/", "see https://host.io/wandering/mountain/"]
    rows, keys = [], {}
    for i in range(150):
        keys[i] = "".join(rng.choice(alphabet, 32))
        rows.append((i, f"{' '.join(rng.choice(words, 80))} {heads[i % 3]}{keys[i]} {' '.join(rng.choice(words, 30))}", "en", "a"))
    got = {r.doc_id: r for r in secret_scan.scan(docs_of(rows)).collect()}
    found = 0
    for i, text, *_ in rows:
        spans = [s.split(":") for s in filter(None, got[i].spans.split(","))]
        assert len(spans) == got[i].n_random <= 1
        found += any(keys[i] in text[int(a) : int(b)] for _, a, b in spans)
    assert found >= 130


def random_spans(docs):
    return sum(r.n_random for r in secret_scan.scan(docs).collect())


def test_clean_documents_with_few_words_report_nothing(docs_of):
    rng = np.random.default_rng(8)
    words = ["water", "tree", "under", "the", "lightning", "of", "houses", "and", "wandering", "mountain", "river", "stone"]
    path = lambda n: "/".join(rng.choice(words, n))
    digits = lambda n: "".join(rng.choice(list("0123456789"), n))
    short = [(i, f"https://{path(5)}", "en", "a") for i in range(80)]
    other = [(i, f"река и камень {path(6)} под водой {digits(26)}", "ru", "a") for i in range(80)]
    blobs = [(i, f"see {path(60)} there", "en", "a") for i in range(80)]
    english = [(1000 + i, " ".join(rng.choice(words, 80)), "en", "a") for i in range(20)]
    for rows in (short, other, blobs, short + english, other + english, blobs + english):
        assert random_spans(docs_of(rows, 1)) <= 2, rows[0]


def test_keys_are_found_where_only_other_documents_have_words(docs_of):
    rng = np.random.default_rng(9)
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    words = ["water", "tree", "under", "the", "lightning", "of", "houses", "and", "wandering", "mountain", "river", "stone"]
    rows = [(i, f"ключ {''.join(rng.choice(alphabet, 40))} здесь", "ru", "a") for i in range(60)]
    rows += [(1000 + i, " ".join(rng.choice(words, 80)), "en", "a") for i in range(20)]
    got = {r.doc_id: r.n_random for r in secret_scan.scan(docs_of(rows, 1)).collect()}
    assert sum(got[i] == 1 for i in range(60)) >= 50
    assert not any(got[1000 + i] for i in range(20))


def test_decoys_that_were_made_are_what_counts():
    # Two decoys for 40 candidates tell nothing of one in twenty; none tell nothing at all.
    assert secret_scan.thresholds({(5, 0): 40}, {(5, 0): 2})[5] == secret_scan.BINS
    assert secret_scan.thresholds({(5, 30): 40}, {(5, 0): 2})[5] == secret_scan.BINS
    assert secret_scan.thresholds({(5, 30): 400}, {})[5] == secret_scan.BINS
    assert secret_scan.thresholds({(5, 30): 40}, {(5, 0): 320})[5] <= 30
    assert len(secret_scan.decoys("x", 0, 1, secret_scan.Words("x", [(0, 1)]), others=lambda: "abcdefghij")) == 8


def test_long_texts_take_time_in_proportion():
    rng = np.random.default_rng(5)
    alphabet = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    lines = ["".join(x) for x in alphabet[rng.integers(0, 64, (20_000, 76))]]
    text = "some words before it\n" + "\n".join(lines)
    began = time.process_time()
    found = secret_scan.candidates(text, secret_scan.known_spans(text))
    words = secret_scan.Words(text, found)
    made = [d for s, e in found for d in secret_scan.decoys(text, s, e, words, others=lambda: "word" * 60_000)]
    chances = secret_scan.combined_all([text[s:e] for s, e in found] + made)
    assert time.process_time() - began < 20 and len(chances) == len(found) + len(made) and len(found) >= 20_000
    inside = secret_scan.wholes(found)
    assert all(i < 0 or found[i][0] <= s and e <= found[i][1] for i, (s, e) in zip(inside, found, strict=True))


def test_spans_and_words_as_by_comparing_all():
    rng = np.random.default_rng(6)
    for _ in range(300):
        spans = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 90, 6), rng.integers(1, 12, 6), strict=True)]
        taken = secret_scan._Taken(spans)
        for start in range(0, 95, 3):
            for end in (start + 1, start + 7):
                assert taken.meets(start, end) == any(s < end and start < e for s, e in spans)
        text = "".join(rng.choice(list("ab1 ./"), 100))
        words = secret_scan.Words(text, spans)
        free = [m for m in re.finditer("[A-Za-z0-9]+", text) if not any(s < m.end() and m.start() < e for s, e in spans)]
        assert words.words == [m[0] for m in free if len(m[0]) < secret_scan.SHORTEST]
        later = [m[0] for m in free if m.start() >= spans[0][1]]
        earlier = [m[0] for m in free if m.start() < spans[0][1]]
        assert words.around(spans[0][1], 30) == "".join(later + earlier)[:30]
    found = [(0, 90), (3, 30), (40, 90), (100, 130), (100, 125)]
    longer = [[j for j, b in enumerate(found) if b[0] <= a[0] and a[1] <= b[1] and a != b] for a in found]
    assert secret_scan.wholes(found) == [(j or [-1])[0] for j in longer]
