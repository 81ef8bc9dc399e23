"""The manifest's trees against a plain recursive one."""

import hashlib
import zlib

import duckdb
import pytest

from smelter.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank long, node string, size int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def digest(row, text):
    return sha("".join(field(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def climb(hashes):
    """(root, siblings left and right of each one's way)."""
    ways, level, at = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 8 * 8 : place // 8 * 8 + 8]
            ways[i].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
            at[i] = place // 8
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], ways


def plain(rows):
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = [(r, digest(r, r.text)) for r in rows if r.lang == lang]
        own.sort(key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1]))
        trees[lang] = own, *climb([h for _, h in own])
    root, upper = climb([trees[lang][1] for lang in langs])
    found = []
    for lang, up in zip(langs, upper):
        own, subroot, ways = trees[lang]
        for (row, leaf), way in zip(own, ways):
            way = way + up
            text = row.text
            if text is not None and row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            acc = digest(row, text)
            for left, right in way:
                acc = sha(left + acc + right)
            proof = sha("".join(a + b for a, b in way))
            found.append((row.doc_id, leaf, subroot, root, proof, acc, acc == root))
    return found


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, v) for v in r])


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, f"Text {i} ÄÖ 日本" * (i % 5), "en", "s", i, 1, "x", 2) for i in range(700)]
    rows += [(i, f"T{i}", None, None, None, None, None, None) for i in range(9)]
    rows += [(i, "Zé", f"lang{i % 70:02d}", None, None, None, None, None) for i in range(1000, 1075)]
    rows += [(3, "Twice", "de", None, 1, None, None, None)] * 5 + [(3, "Other", "de", None, 1, None, None, None)]
    rows += [(None, None, "de", None, None, None, None, None), (None, "", "de", None, None, None, None, None)]
    rows += [(77, "WORD " * 200_000, "", "", 0, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_proofs_equal_a_plain_tree(odd, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    got = [tuple(r) for r in manifest.proofs_of_tampered(odd).collect()]
    assert in_order(got) == in_order(plain(odd.collect()))
    assert {r[-1] for r in got} == {True, False}


def test_proofs_equal_sql(odd):
    con = duckdb.connect()
    con.register("documents", odd.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
    assert in_order(con.execute(manifest.PROOFS_SQL).fetchall()) == in_order(plain(odd.collect()))


def test_one_row_and_no_rows(spark, odd):
    one = spark.createDataFrame([(1, "A", "en", None, None, None, None, None)], SCHEMA)
    row = manifest.proofs_of_tampered(one).collect()[0]
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")
    assert manifest.proofs_of_tampered(odd.limit(0)).count() == 0
