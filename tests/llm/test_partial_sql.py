"""What SQL can say of operators whose whole result it can't: counts of the quality rules, sizes and targets of the mix."""

import os

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

from catalume.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def sql(query):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    return sorted(con.sql(query).fetchall())


def test_counts_of_quality_rules(spark):
    want = sql(rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
      threes AS (SELECT doc_id, i, w[i:i + 2] AS three FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
      often AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) > 1 AS twice FROM threes),
      marked AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM often, (SELECT unnest([0, 1, 2]) AS k) WHERE twice GROUP BY doc_id),
      lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
      counts AS (SELECT w.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(m.n, 0) AS n_repeat_words
        FROM w LEFT JOIN lines l ON l.doc_id = w.doc_id LEFT JOIN marked m ON m.doc_id = w.doc_id)
      SELECT doc_id, n_words, CAST(word_chars AS BIGINT), n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words FROM counts""")
    got = QUERIES["op8_quality_rules"](spark, SF).collect()
    assert sorted((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in got) == want
    assert not any(x.kept and x.base_failed for x in got)


def test_sizes_and_targets_of_the_mix(spark):
    got = QUERIES["op9_source_mixing"](spark, SF).collect()
    sizes = dict(sql(f"SELECT doc_id, CAST(len({WORDS}) AS BIGINT) FROM documents"))
    assert {x.doc_id: x.size for x in got} == sizes
    source = sql(f"SELECT source, CAST(sum(len({WORDS})) AS BIGINT) FROM documents GROUP BY source")
    names = {x.doc_id: x.source for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    order = sorted((s for s, _ in source if s is not None)) + [None] * any(s is None for s, _ in source)
    weight, size = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, dict(source)
    want, left, free = {}, 1.5 * sum(size.values()), set(order)
    while over := {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * size[s]}:
        want |= {s: 2.0 * size[s] for s in over}
        free -= over
        left -= sum(2 * size[s] for s in over)
    want |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    assert all(x.source_size == size[names[x.doc_id]] and x.target == pytest.approx(want[names[x.doc_id]]) and x.taken <= 2 * x.size for x in got)
    taken = {s: sum(x.taken for x in got if names[x.doc_id] == s) for s in order}
    assert all(abs(taken[s] - want[s]) <= max(x.size for x in got if names[x.doc_id] == s) for s in order)
