"""The derived tables as SQL, for checking results; named parts and what each needs."""

from __future__ import annotations

import re

from pagewright.config import NAMESPACE
from pagewright.functions.text import INDEX_STOP_WORDS, STOP_WORDS


def listed(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def uuid5(key: str) -> str:
    h = f"sha1(unhex('{NAMESPACE.replace('-', '')}') || encode({key}))"
    return f"(SELECT substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(h,17,1)), 1)||substr(h,18,3)||'-'||substr(h,21,12) FROM (SELECT {h} AS h))"


DOC_KEY = "lower(trim(source_file_name))||'-'||lower(trim(correspondence_type))||'-'||lower(trim(case_ref))"
STOP, INDEX_STOP = listed(STOP_WORDS), listed(INDEX_STOP_WORDS)

PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "meta0": ((), """SELECT doc_id, 'doc_'||doc_id||'.pdf' AS source_file_name, '26-7'||lpad(substr(source,4),5,'0') AS case_ref, upper(lang) AS correspondence_type, TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 365 AS INTEGER)) AS received_date FROM documents"""),
    "meta": (("meta0",), f"SELECT *, 's3://cases/'||case_ref||'/'||source_file_name AS source_file_s3_uri, {uuid5(DOC_KEY)} AS source_doc_id FROM meta0"),
    "par0": ((), "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS p FROM documents"),
    "par": (("par0",), r"SELECT doc_id, p, list_filter(regexp_split_to_array(line, '[ \t\r\n]+'), lambda x: x <> '') AS ws FROM par0"),
    "parp": (("par",), "SELECT doc_id, p, ws, coalesce(sum(CAST(ceil(len(ws)/12.0) AS BIGINT) + CASE WHEN p % 4 = 3 THEN 2 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM par"),
    "vrow0": (("parp",), "SELECT doc_id, p, first, ws, unnest(range(0, CAST(ceil(len(ws)/12.0) AS BIGINT))) AS r FROM parp WHERE len(ws) > 0"),
    "vrow": (("vrow0",), "SELECT doc_id, p, first + r AS row, CAST((first + r) // 22 + 1 AS INTEGER) AS page_num, CAST((first + r) % 22 AS INTEGER) AS row_no, list_slice(ws, r*12+1, r*12+12) AS words FROM vrow0"),
    "w0": (("vrow",), "SELECT doc_id, p, row, page_num, row_no, unnest(words) AS text, generate_subscripts(words, 1) - 1 AS col_no FROM vrow"),
    "w1": (("w0",), "SELECT *, 50 + 8 * (coalesce(sum(length(text)) OVER (PARTITION BY doc_id, row ORDER BY col_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + col_no) AS \"left\", 50 + 40 * row_no AS top FROM w0"),
    "w": (("w1",), "SELECT doc_id, page_num, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY row_no, col_no) - 1 AS word_pos, p, row, row_no, col_no, text, CAST(\"left\" AS BIGINT) AS \"left\", top, CAST(\"left\" + 8*length(text) AS BIGINT) AS \"right\", top + 32 AS bottom, CASE WHEN (doc_id*31 + row*7 + col_no) % 997 = 0 THEN 'HANDWRITING' ELSE 'PRINTED' END AS text_type, right(rtrim(text), 1) IN ('.', '?', '!') AS ends FROM w1"),
    "wg": (("w",), "SELECT *, coalesce(top - lag(bottom) OVER (PARTITION BY doc_id, page_num ORDER BY word_pos) > 50, false) AS gap FROM w"),
    "wn": (("wg",), """SELECT doc_id, page_num, word_pos, min(CASE WHEN gap THEN word_pos END) OVER (PARTITION BY doc_id, page_num ORDER BY word_pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_gap, min(CASE WHEN ends THEN word_pos END) OVER (PARTITION BY doc_id, page_num ORDER BY word_pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_end, count(*) OVER (PARTITION BY doc_id, page_num) AS n FROM wg"""),
    "cend": (("wn",), "SELECT a.doc_id, a.page_num, a.word_pos AS s, least(a.n - 1, coalesce(a.next_gap - 1, a.n), a.word_pos + 119, coalesce(b.next_end, a.n)) AS e, a.n FROM wn a LEFT JOIN wn b ON b.doc_id = a.doc_id AND b.page_num = a.page_num AND b.word_pos = a.word_pos + 79"),
    "cs": (("cend",), "SELECT doc_id, page_num, s, e, n FROM cend WHERE s = 0 UNION ALL SELECT c.doc_id, c.page_num, c.s, c.e, c.n FROM cs JOIN cend c ON c.doc_id = cs.doc_id AND c.page_num = cs.page_num AND c.s = cs.e + 1"),
    "csn": (("cs",), "SELECT doc_id, page_num, s, e, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY s) - 1 AS chunk_index FROM cs"),
    "c0": (("csn", "w"), """SELECT k.doc_id, k.page_num, k.chunk_index, string_agg(w.text, ' ' ORDER BY w.word_pos) AS chunk_text, count(*) AS n_words, min(w."left") AS "left", min(w.top) AS top, max(w."right") AS "right", max(w.bottom) AS bottom FROM csn k JOIN w ON w.doc_id = k.doc_id AND w.page_num = k.page_num AND w.word_pos BETWEEN k.s AND k.e GROUP BY ALL"""),
    "hand": (("w",), "SELECT doc_id, page_num, bool_or(text_type = 'HANDWRITING') AS page_contains_handwriting FROM w GROUP BY ALL"),
    "c": (("c0", "meta", "hand"), f"SELECT c0.*, m.source_file_name, m.case_ref, m.correspondence_type, m.received_date, m.source_file_s3_uri, m.source_doc_id, h.page_contains_handwriting, {uuid5(DOC_KEY + '||' + repr('-') + '||page_num||' + repr('-') + '||chunk_index')} AS chunk_id FROM c0 JOIN meta m USING (doc_id) JOIN hand h USING (doc_id, page_num)"),
    "ln0": (("vrow",), """SELECT doc_id, page_num, p, row_no, array_to_string(words, ' ') AS text, 50 AS "left", 50 + 40*row_no AS top, 50 + 8*(list_sum(list_transform(words, lambda x: length(x))) + len(words) - 1) AS "right", len(words) AS n_words, 90.0 + p % 10 AS confidence FROM vrow
      UNION ALL SELECT DISTINCT doc_id, page_num, -1, 23, 'Page '||page_num, 50, 960, 50 + 8*(5 + length(CAST(page_num AS VARCHAR))), 2, 99.0 FROM vrow"""),
    "ln": (("ln0",), """SELECT doc_id, page_num, p, row_no, text, "left", top, CAST("right" AS BIGINT) AS "right", top + 32 AS bottom, n_words, CAST(confidence AS DOUBLE) AS confidence, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY top, row_no) - 1 AS line_pos FROM ln0"""),
    "lnf": (("ln",), r"SELECT * FROM ln WHERE top < 950 AND NOT regexp_matches(trim(text), '(?i)^Page\s*\d+') AND trim(text) <> ''"),
    "lb": (("ln",), """SELECT doc_id, page_num, p, string_agg(text, ' ' ORDER BY row_no) AS text, min("left") AS "left", min(top) AS top, max("right") AS "right", max(bottom) AS bottom, max(confidence) AS confidence, count(*) AS n_lines, ['LAYOUT_SECTION_HEADER','LAYOUT_TEXT','LAYOUT_TEXT','LAYOUT_LIST','LAYOUT_TABLE'][p % 5 + 1] AS layout_type FROM ln WHERE p >= 0 GROUP BY doc_id, page_num, p"""),
    "lnn": (("ln",), "SELECT *, row_number() OVER (PARTITION BY doc_id, page_num, p ORDER BY row_no) AS k, length(trim(text)) AS len FROM ln WHERE p >= 0"),
    "lt": (("lnn",), "SELECT doc_id, page_num, p, k, len AS held, 0 AS part_no FROM lnn WHERE k = 1 AND p % 5 IN (0, 1, 2) UNION ALL SELECT n.doc_id, n.page_num, n.p, n.k, CASE WHEN lt.held + 1 + n.len > 80 THEN n.len ELSE lt.held + 1 + n.len END, lt.part_no + CASE WHEN lt.held + 1 + n.len > 80 THEN 1 ELSE 0 END FROM lt JOIN lnn n ON n.doc_id = lt.doc_id AND n.page_num = lt.page_num AND n.p = lt.p AND n.k = lt.k + 1"),
    "ltc": (("lt", "lnn"), """SELECT doc_id, page_num, p, part_no, string_agg(text, ' ' ORDER BY k) AS chunk_text, min("left") AS "left", min(top) AS top, max("right") AS "right", max(bottom) AS bottom, max(confidence) AS confidence FROM lt JOIN lnn USING (doc_id, page_num, p, k) GROUP BY ALL"""),
    "lic": (("lnn",), """SELECT doc_id, page_num, p, k - 1 AS part_no, text AS chunk_text, "left", top, "right", bottom, confidence FROM lnn WHERE p % 5 = 3 AND trim(text) <> ''"""),
    "cell": (("w",), """SELECT doc_id, page_num, p, row_no, col_no // 3 AS cell, string_agg(text, ' ' ORDER BY col_no) AS text, min("left") AS "left", min(top) + (col_no // 3) * 3 % 7 AS top, max("right") AS "right", max(bottom) + (col_no // 3) * 3 % 7 AS bottom FROM w WHERE p % 5 = 4 GROUP BY doc_id, page_num, p, row_no, col_no // 3"""),
    "cb": (("cell",), """SELECT *, row_number() OVER (PARTITION BY doc_id, page_num, p ORDER BY top, "left", text) AS k, count(*) FILTER (WHERE bottom > top) OVER (PARTITION BY doc_id, page_num, p) AS nt, sum(bottom - top) FILTER (WHERE bottom > top) OVER (PARTITION BY doc_id, page_num, p) AS tall FROM cell"""),
    "vr": (("cb",), "SELECT doc_id, page_num, p, k, top + bottom AS mid, 0 AS row_no FROM cb WHERE k = 1 UNION ALL SELECT n.doc_id, n.page_num, n.p, n.k, CASE WHEN abs(n.top + n.bottom - vr.mid) * n.nt >= n.tall THEN n.top + n.bottom ELSE vr.mid END, vr.row_no + CASE WHEN abs(n.top + n.bottom - vr.mid) * n.nt >= n.tall THEN 1 ELSE 0 END FROM vr JOIN cb n ON n.doc_id = vr.doc_id AND n.page_num = vr.page_num AND n.p = vr.p AND n.k = vr.k + 1"),
    "vrc": (("vr", "cb"), """SELECT vr.doc_id, vr.page_num, vr.p, vr.row_no AS part_no, string_agg(text, ' ' ORDER BY "left", top, text) AS chunk_text, min("left") AS "left", min(top) AS top, max("right") AS "right", max(bottom) AS bottom FROM vr JOIN cb USING (doc_id, page_num, p, k) GROUP BY ALL"""),
    "ltb0": (("vrc",), """SELECT doc_id, page_num, p, string_agg(chunk_text, chr(10) ORDER BY part_no) AS whole, min("left") AS "left", min(top) AS top, max("right") AS "right", max(bottom) AS bottom FROM vrc GROUP BY doc_id, page_num, p"""),
    "ltb": (("vrc", "ltb0"), """SELECT doc_id, page_num, p, 0 AS part_no, whole AS chunk_text, "left", top, "right", bottom FROM ltb0 WHERE length(whole) < 300 UNION ALL SELECT v.* FROM vrc v JOIN ltb0 b USING (doc_id, page_num, p) WHERE length(b.whole) >= 300"""),
    "at0": (("ltc", "lic", "ltb"), """SELECT doc_id, page_num, p, part_no, chunk_text, "left", top, "right", bottom, confidence, CASE WHEN p % 5 = 0 THEN 'LAYOUT_SECTION_HEADER' ELSE 'LAYOUT_TEXT' END AS chunk_type FROM ltc UNION ALL SELECT *, 'LAYOUT_TEXT' FROM lic UNION ALL SELECT *, CAST(90 + p % 10 AS DOUBLE), 'LAYOUT_TABLE' FROM ltb"""),
    "atc": (("at0",), r"SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY p, part_no) - 1 AS chunk_index, len(list_filter(regexp_split_to_array(chunk_text, '[ \t\r\n]+'), lambda x: x <> '')) AS n FROM at0"),
    "mg": (("atc",), "SELECT doc_id, page_num, chunk_index, n AS held, bottom, 0 AS part_no FROM atc WHERE chunk_index = 0 UNION ALL SELECT a.doc_id, a.page_num, a.chunk_index, CASE WHEN mg.held + a.n > 80 OR abs(a.top - mg.bottom) > 500 THEN a.n ELSE mg.held + a.n END, a.bottom, mg.part_no + CASE WHEN mg.held + a.n > 80 OR abs(a.top - mg.bottom) > 500 THEN 1 ELSE 0 END FROM mg JOIN atc a ON a.doc_id = mg.doc_id AND a.page_num = mg.page_num AND a.chunk_index = mg.chunk_index + 1"),
    "st0": ((), r"SELECT item_id AS query_id, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda x: length(x) > 3) AS ws FROM benchmark"),
    "st": (("st0",), "SELECT query_id, array_to_string(list_slice(ws, 1, 2), ' ') AS search_term, array_to_string(list_slice(ws, 3, 5), ', ') AS acceptable_terms, '26-7'||lpad(CAST(query_id % 20 AS VARCHAR), 5, '0') AS case_ref FROM st0"),
    "tk": (("c",), rf"SELECT chunk_id, case_ref, list_filter(regexp_extract_all(lower(chunk_text), '\p{{L}}+'), lambda x: x NOT IN {INDEX_STOP}) AS toks FROM c"),
    "tot": (("tk",), "SELECT count(*) AS n, avg(len(toks)) AS average FROM tk"),
    "ask": (("st",), rf"SELECT query_id, case_ref, token, count(*) AS times FROM (SELECT query_id, case_ref, unnest(list_filter(regexp_extract_all(lower(search_term), '\p{{L}}+'), lambda x: x NOT IN {INDEX_STOP})) AS token FROM st) GROUP BY ALL"),
    "held": (("tk", "ask"), "SELECT chunk_id, case_ref, size, token, count(*) AS tf FROM (SELECT chunk_id, case_ref, len(toks) AS size, unnest(toks) AS token FROM tk) WHERE token IN (SELECT token FROM ask) GROUP BY ALL"),
    "dfq": (("held",), "SELECT token, count(*) AS df FROM held GROUP BY token"),
    "bm": (("held", "ask", "dfq", "tot"), "SELECT query_id, chunk_id, round(sum(times * ln(1 + (n - df + 0.5)/(df + 0.5)) * tf / (tf + 1.2*(0.25 + 0.75*size/average))), 6) AS score FROM ask JOIN held USING (case_ref, token) JOIN dfq USING (token), tot GROUP BY ALL"),
    "ev": ((), "SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings"),
    "cv": (("c", "ev"), "SELECT c.chunk_id, c.case_ref, ev.v FROM c JOIN ev ON ev.vec_id = (c.doc_id*7 + c.page_num*3 + c.chunk_index) % (SELECT count(*) FROM ev)"),
    "vs0": (("st", "ev", "cv"), "SELECT st.query_id, cv.chunk_id, round((1 + list_cosine_similarity(ev.v, cv.v))/2, 6) AS score FROM st JOIN ev ON ev.vec_id = st.query_id JOIN cv USING (case_ref)"),
    "vs": (("vs0",), "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM vs0) WHERE rank <= 40"),
    "hy0": (("bm", "vs"), "SELECT query_id, chunk_id, round(sum(score), 5) AS score FROM (SELECT query_id, chunk_id, score*20.0 AS score FROM bm UNION ALL SELECT query_id, chunk_id, score*4.0 FROM vs) GROUP BY ALL"),
    "hits": (("hy0",), "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM hy0) WHERE rank <= 40"),
    "ex": (("st", "c"), r"SELECT query_id, chunk_id FROM (SELECT query_id, case_ref, list_filter(regexp_split_to_array(lower(trim(search_term)), '[ \t\r\n]+'), lambda x: x <> '') AS ws FROM st) JOIN c USING (case_ref) WHERE len(list_filter(ws, lambda x: contains(lower(chunk_text), x))) > 0"),
    "tf": (("hits", "c", "st"), "SELECT query_id, chunk_id, rank, page_num, chunk_text, search_term, CASE WHEN search_term = '' THEN 0 ELSE CAST((length(lower(chunk_text)) - length(replace(lower(chunk_text), lower(search_term), ''))) / length(search_term) AS INTEGER) END AS n FROM hits JOIN c USING (chunk_id) JOIN st USING (query_id)"),
    "sr0": (("tf",), "SELECT query_id, string_agg(chunk_id, ', ' ORDER BY rank) AS all_chunk_ids, string_agg(CAST(page_num AS VARCHAR), ', ' ORDER BY rank) AS all_page_numbers, count(*) AS total_results, CAST(sum(n) AS BIGINT) AS total_term_frequency FROM tf GROUP BY query_id"),
    "exs": (("ex",), "SELECT query_id, string_agg(chunk_id, ', ' ORDER BY chunk_id) AS expected_chunk_id FROM ex GROUP BY query_id"),
    "sr": (("st", "sr0", "exs"), "SELECT query_id, search_term, acceptable_terms, coalesce(all_chunk_ids, '') AS all_chunk_ids, coalesce(all_page_numbers, '') AS all_page_numbers, coalesce(expected_chunk_id, '') AS expected_chunk_id, coalesce(total_results, 0) AS total_results, coalesce(total_term_frequency, 0) AS total_term_frequency FROM st LEFT JOIN sr0 USING (query_id) LEFT JOIN exs USING (query_id) WHERE trim(search_term) <> ''"),
    "pr0": (("sr",), "SELECT *, list_filter(list_transform(string_split(expected_chunk_id, ','), lambda x: trim(x)), lambda x: x <> '') AS want, list_filter(list_transform(string_split(all_chunk_ids, ','), lambda x: trim(x)), lambda x: x <> '') AS got FROM sr"),
    "pr": (("pr0",), "SELECT *, CASE WHEN len(want) > 0 THEN CASE WHEN len(got) > 0 THEN round_even(len(list_filter(want, lambda x: list_contains(got, x))) / len(got) * 100, 2) ELSE 0.0 END WHEN len(got) > 0 THEN 0.0 ELSE 100.0 END AS precision, CASE WHEN len(want) > 0 THEN round_even(len(list_filter(want, lambda x: list_contains(got, x))) / len(want) * 100, 2) WHEN len(got) > 0 THEN NULL ELSE 100.0 END AS recall, array_to_string(list_filter(want, lambda x: NOT list_contains(got, x)), ', ') AS missing_chunk_ids FROM pr0"),
    "tp0": (("hits", "c", "st"), rf"SELECT query_id, list_has_any(list_filter(regexp_extract_all(lower(search_term), '[\p{{L}}\p{{N}}_]+'), lambda x: x NOT IN {STOP}), regexp_extract_all(lower(chunk_text), '[\p{{L}}\p{{N}}_]+')) AS has, len(list_filter(list_filter(list_transform(string_split(acceptable_terms, ','), lambda x: lower(trim(x))), lambda x: x <> '' AND x <> lower(trim(search_term))), lambda t: list_has_any(list_filter(regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+'), lambda x: x NOT IN {STOP}), regexp_extract_all(lower(chunk_text), '[\p{{L}}\p{{N}}_]+')))) > 0 AS other FROM hits JOIN c USING (chunk_id) JOIN st USING (query_id) WHERE chunk_text <> ''"),
    "tp": (("tp0",), "SELECT query_id, count(*) FILTER (WHERE has) AS chunks_with_search_term, count(*) FILTER (WHERE other) AS chunks_with_acceptable, count(*) FILTER (WHERE has OR other) AS chunks_with_any_term FROM tp0 GROUP BY query_id"),
    "rel": (("pr", "tp"), "SELECT query_id, search_term, expected_chunk_id, total_results, precision, recall, missing_chunk_ids, CASE WHEN total_results > 0 THEN round_even(coalesce(chunks_with_search_term, 0) / total_results * 100, 2) END AS term_based_precision, CASE WHEN total_results > 0 THEN round_even(coalesce(chunks_with_any_term, 0) / total_results * 100, 2) END AS acceptable_term_based_precision, CAST(query_id % 5 AS INTEGER) AS manual_identifications, total_term_frequency, total_term_frequency - CAST(query_id % 5 AS INTEGER) AS term_freq_difference FROM pr LEFT JOIN tp USING (query_id)"),
    "summ0": (("rel",), "SELECT count(*) AS total_queries, count(*) FILTER (WHERE total_results > 0) AS queries_with_results, coalesce(sum(total_results) FILTER (WHERE acceptable_term_based_precision > 0), 0) AS returned, count(*) FILTER (WHERE trim(expected_chunk_id) <> '') AS queries_with_expected_chunk, coalesce(avg(precision), 0.0) AS p, coalesce(avg(recall), 0.0) AS r, coalesce(avg(acceptable_term_based_precision), 0.0) AS a FROM rel"),
    "summ": (("summ0",), "SELECT total_queries, queries_with_results, round_even(queries_with_results/total_queries, 2) AS result_rate, round_even(returned/total_queries, 2) AS avg_chunks_returned, queries_with_expected_chunk, round_even(p, 2) AS avg_precision, round_even(r, 2) AS avg_recall, round_even(CASE WHEN p + r > 0 THEN 2*p*r/(p+r) ELSE 0.0 END, 2) AS avg_f1_score, round_even(a, 2) AS avg_acceptable_term_based_precision, round_even(returned/total_queries * pow(a/100, 2), 4) AS optimization_score FROM summ0 WHERE total_queries > 0"),
    "cl": (("bm", "vs0"), "SELECT query_id, chunk_id, coalesce(bm.score, 0.0) AS lexical, coalesce(vs0.score, 0.0) AS neural FROM vs0 LEFT JOIN bm USING (query_id, chunk_id)"),
    "od": ((), "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders"),
    "odv": (("od",), "SELECT o_orderkey, d, day(d) AS dd, month(d) AS mm, year(d) AS yy, strftime(d, '%B') AS full_name, strftime(d, '%b') AS short_name, CASE WHEN day(d) IN (1,21,31) THEN 'st' WHEN day(d) IN (2,22) THEN 'nd' WHEN day(d) IN (3,23) THEN 'rd' ELSE 'th' END AS th FROM od"),
}

PARTS |= {
    "dc": (("odv",), "SELECT o_orderkey AS chunk_id, o_custkey AS case_ref, 'Order '||o_orderpriority||' paid '||dd||' '||short_name||' '||yy||' in full.' AS chunk_text FROM odv JOIN orders USING (o_orderkey)"),
    "dst": (("odv",), "SELECT o_orderkey AS query_id, o_custkey AS case_ref, o_orderpriority||' of '||dd||' '||full_name||' '||yy AS search_term, dd, mm, yy, full_name, short_name, th FROM odv JOIN orders USING (o_orderkey) WHERE o_orderkey % 50 = 0"),
    "dvs0": (("dst", "ev", "dc"), "SELECT q.query_id, k.chunk_id, round((1 + list_cosine_similarity(a.v, b.v))/2, 6) AS score FROM dst q JOIN dc k USING (case_ref) JOIN ev a ON a.vec_id = q.query_id % (SELECT count(*) FROM ev) JOIN ev b ON b.vec_id = k.chunk_id % (SELECT count(*) FROM ev)"),
    "dvs": (("dvs0",), "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM dvs0) WHERE rank <= 40"),
}
# the lexical clause over dated terms and texts: the same parts, over dc and dst
for _name in ("tk", "tot", "ask", "held", "dfq", "bm"):
    _needs, _body = PARTS[_name]
    PARTS["d" + _name] = tuple("d" + n for n in _needs), re.sub(r"(FROM|JOIN|,) (c|st|tk|tot|ask|held|dfq)\b", r"\1 d\2", _body)

RECURSIVE = {"cs", "lt", "vr", "mg"}


def sql(body: str, *needs: str) -> str:
    """The query with all parts that it needs before it."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for below in PARTS[name][0]:
                add(below)
            order.append(name)

    for name in needs:
        add(name)
    parts = ",\n".join(f"{n} AS {'' if n in RECURSIVE else 'MATERIALIZED '}({PARTS[n][1]})" for n in order)
    return f"WITH RECURSIVE {parts}\n{body}" if order else body
