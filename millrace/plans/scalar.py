"""Scalar, aggregate and table functions, by family, over the driver's tables."""

from __future__ import annotations

from millrace.plans.catalogue import register_sql

register_sql(
    "string_functions",
    """
    SELECT p_partkey, concat(p_name, NULL, '-', p_size) AS c1, concat_ws('/', p_brand, NULL, p_type) AS c2, substr(p_name, 3) AS s1, substr(p_name, -1, 4) AS s2, substring(p_name, 2, 3) AS s3,
           left(p_name, 3) AS l1, left(p_name, -2) AS l2, right(p_name, 3) AS r1, right(p_name, -2) AS r2, strpos(p_name, 'a')::int AS p1, position('e' IN p_name)::int AS p2,
           upper(p_name) AS u, lower(p_brand) AS lo, reverse(p_name) AS rev, repeat('ab', 3) AS rep, lpad(p_name, 5, '*') AS lp, rpad(p_brand, 12, '.') AS rp, replace(p_type, 'E', '3') AS re,
           length(p_name)::int AS n, split_part(p_type, ' ', 2) AS sp, translate(p_name, 'abc', 'xyz') AS tr, ascii(p_name)::int AS asc1, md5(p_name) AS m, starts_with(p_type, 'PROMO') AS sw,
           ltrim(p_name, 'p') AS lt, rtrim(p_name, '0123456789') AS rt, btrim(p_brand, 'B1') AS bt, to_hex(p_partkey) AS h, octet_length(p_name::bytea)::int AS ol, p_name LIKE '%a%' AS lk, p_name ILIKE '%A%' AS ilk, overlay(p_name PLACING 'ZZ' FROM 2 FOR 1) AS ov
    FROM part
    """,
    """
    SELECT p_partkey, concat(p_name, NULL, '-', p_size) AS c1, concat_ws('/', p_brand, NULL, p_type) AS c2, substr(p_name, 3) AS s1, substr(p_name, 1, 2) AS s2, substring(p_name, 2, 3) AS s3,
           left(p_name, 3) AS l1, left(p_name, -2) AS l2, right(p_name, 3) AS r1, right(p_name, -2) AS r2, strpos(p_name, 'a')::int AS p1, position('e' IN p_name)::int AS p2,
           upper(p_name) AS u, lower(p_brand) AS lo, reverse(p_name) AS rev, repeat('ab', 3) AS rep, lpad(p_name, 5, '*') AS lp, rpad(p_brand, 12, '.') AS rp, replace(p_type, 'E', '3') AS re,
           length(p_name)::int AS n, split_part(p_type, ' ', 2) AS sp, translate(p_name, 'abc', 'xyz') AS tr, ascii(p_name)::int AS asc1, md5(p_name) AS m, starts_with(p_type, 'PROMO') AS sw,
           ltrim(p_name, 'p') AS lt, rtrim(p_name, '0123456789') AS rt, trim(p_brand, 'B1') AS bt, lower(to_hex(p_partkey)) AS h, strlen(p_name)::int AS ol, p_name LIKE '%a%' AS lk, p_name ILIKE '%A%' AS ilk, left(p_name, 1) || 'ZZ' || substr(p_name, 3) AS ov
    FROM part
    """,
)
register_sql(
    "regexp_functions",
    r"""
    SELECT p_partkey, p_type ~ '^PRO' AS m1, p_type !~ 'STEEL$' AS m2, p_type ~* 'steel' AS m3, regexp_replace(p_name, '[0-9]', '#') AS r1, regexp_replace(p_name, '[0-9]', '#', 'g') AS r2, regexp_count(p_name, '[aeiou]')::int AS c, array_to_string(regexp_split_to_array(p_type, ' '), '|') AS sp
    FROM part
    """,
    r"""
    SELECT p_partkey, regexp_matches(p_type, '^PRO') AS m1, NOT regexp_matches(p_type, 'STEEL$') AS m2, regexp_matches(p_type, '(?i)steel') AS m3, regexp_replace(p_name, '[0-9]', '#') AS r1, regexp_replace(p_name, '[0-9]', '#', 'g') AS r2, len(regexp_extract_all(p_name, '[aeiou]'))::int AS c, array_to_string(regexp_split_to_array(p_type, ' '), '|') AS sp
    FROM part
    """,
)
register_sql(
    "math_functions",
    """
    SELECT c_custkey, abs(c_acctbal) AS a, ceil(c_acctbal)::double precision AS ce, floor(c_acctbal)::double precision AS fl, trunc(c_acctbal)::double precision AS tr, sign(c_acctbal)::double precision AS sg, round(sqrt(abs(c_acctbal)), 9) AS sq, round(cbrt(c_custkey), 9) AS cb,
           round(ln(c_custkey + 1), 9) AS l, round(log10(c_custkey + 1), 9) AS l10, round(exp(c_nationkey / 10.0::double precision), 7) AS ex, pow(c_nationkey, 2)::double precision AS pw, mod(c_custkey, 7) AS md, round(sin(c_custkey), 9) AS sn, round(cos(c_custkey), 9) AS co, round(atan2(c_custkey, 3), 9) AS at2,
           round(degrees(c_nationkey), 7) AS dg, round(radians(c_nationkey), 9) AS rd, round(sinh(c_nationkey / 10.0::double precision), 7) AS sh, round(tanh(c_nationkey), 9) AS th, round(asinh(c_nationkey), 9) AS ash, (c_custkey & 6) AS b1, (c_custkey | 6) AS b2, (c_custkey << 2) AS b3, (c_custkey >> 1) AS b4
    FROM customer
    """,
)
register_sql("bitwise_xor", "SELECT c_custkey, c_custkey # 5 AS x, ~c_custkey AS n, c_nationkey::double precision ^ 2 AS p FROM customer", "SELECT c_custkey, xor(c_custkey, 5) AS x, ~c_custkey AS n, c_nationkey::double ** 2 AS p FROM customer")
register_sql(
    "degree_trigonometry",
    "SELECT c_custkey, round(sind(c_custkey * 15), 9) AS s, round(cosd(c_custkey * 15), 9) AS c, round(tand(c_nationkey), 9) AS t, round(cotd(c_nationkey + 1), 9) AS ct, round(asind(c_nationkey / 25.0), 9) AS a, round(acosd(c_nationkey / 25.0), 9) AS ac, round(atand(c_nationkey), 9) AS at, round(atan2d(c_nationkey, 3), 9) AS b FROM customer",
    "SELECT c_custkey, round(sin(radians(c_custkey * 15)), 9) + 0.0 AS s, round(cos(radians(c_custkey * 15)), 9) + 0.0 AS c, round(tan(radians(c_nationkey)), 9) AS t, round(1 / tan(radians(c_nationkey + 1)), 9) AS ct, round(degrees(asin(c_nationkey / 25.0)), 9) AS a, round(degrees(acos(c_nationkey / 25.0)), 9) AS ac, round(degrees(atan(c_nationkey)), 9) AS at, round(degrees(atan2(c_nationkey, 3)), 9) AS b FROM customer",
)
register_sql(
    "date_functions",
    """
    SELECT o_orderkey, EXTRACT(YEAR FROM o_orderdate)::int AS y, EXTRACT(MONTH FROM o_orderdate)::int AS mo, EXTRACT(DAY FROM o_orderdate)::int AS d, EXTRACT(dow FROM o_orderdate)::int AS dow, EXTRACT(isodow FROM o_orderdate)::int AS isodow, EXTRACT(doy FROM o_orderdate)::int AS doy, EXTRACT(QUARTER FROM o_orderdate)::int AS q,
           EXTRACT(decade FROM o_orderdate)::int AS dec, EXTRACT(century FROM o_orderdate)::int AS cen, EXTRACT(epoch FROM o_orderdate)::double precision AS ep, CAST(date_trunc('month', o_orderdate) AS DATE) AS tm, CAST(date_trunc('week', o_orderdate) AS DATE) AS tw, CAST(o_orderdate + INTERVAL '1 month' AS DATE) AS am,
           CAST(o_orderdate - INTERVAL '3 days' AS DATE) AS sd, make_date(EXTRACT(YEAR FROM o_orderdate)::int, 2, 3) AS mk, to_char(o_orderdate, 'YYYY-MM-DD HH24:MI:SS') AS tc, EXTRACT(hour FROM o_orderdate)::int AS h
    FROM orders
    """,
    """
    SELECT o_orderkey, EXTRACT(YEAR FROM o_orderdate)::int AS y, EXTRACT(MONTH FROM o_orderdate)::int AS mo, EXTRACT(DAY FROM o_orderdate)::int AS d, EXTRACT(dow FROM o_orderdate)::int AS dow, EXTRACT(isodow FROM o_orderdate)::int AS isodow, EXTRACT(doy FROM o_orderdate)::int AS doy, EXTRACT(QUARTER FROM o_orderdate)::int AS q,
           EXTRACT(decade FROM o_orderdate)::int AS dec, EXTRACT(century FROM o_orderdate)::int AS cen, EXTRACT(epoch FROM o_orderdate)::double AS ep, CAST(date_trunc('month', o_orderdate) AS DATE) AS tm, CAST(date_trunc('week', o_orderdate) AS DATE) AS tw, CAST(o_orderdate + INTERVAL '1 month' AS DATE) AS am,
           CAST(o_orderdate - INTERVAL '3 days' AS DATE) AS sd, make_date(EXTRACT(YEAR FROM o_orderdate)::int, 2, 3) AS mk, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS tc, EXTRACT(hour FROM o_orderdate)::int AS h
    FROM orders
    """,
)
register_sql("date_bin", "SELECT event_id, EXTRACT(epoch FROM date_bin(INTERVAL '15 minutes', ts, TIMESTAMP '2001-01-01 00:00:00'))::bigint AS b FROM events", "SELECT event_id, epoch(time_bucket(INTERVAL '15 minutes', ts, TIMESTAMP '2001-01-01 00:00:00'))::bigint AS b FROM events")
register_sql("to_date_parsing", "SELECT o_orderkey, to_date('2024-' || lpad((1 + o_orderkey % 12)::varchar, 2, '0') || '-05', 'YYYY-MM-DD') AS d FROM orders", "SELECT o_orderkey, make_date(2024, (1 + o_orderkey % 12)::int, 5) AS d FROM orders")
register_sql("bytea_and_digests", "SELECT n_nationkey, encode(sha256(n_name::bytea), 'hex') AS s, encode(n_name::bytea, 'base64') AS b, encode(sha1(n_name::bytea), 'hex') AS s1 FROM nation", "SELECT n_nationkey, sha256(n_name) AS s, to_base64(n_name::blob) AS b, sha1(n_name) AS s1 FROM nation")
register_sql("quoting", "SELECT n_name, quote_literal(n_name) AS ql, quote_ident(n_name) AS qi, quote_nullable(nullif(n_name, 'CHINA')) AS qn, initcap(n_name) AS ic FROM nation", """SELECT n_name, '''' || n_name || '''' AS ql, CASE WHEN regexp_matches(n_name, '^[a-z_][a-z0-9_$]*$') THEN n_name ELSE '"' || n_name || '"' END AS qi, coalesce('''' || nullif(n_name, 'CHINA') || '''', 'NULL') AS qn, list_aggregate([upper(x[1]) || lower(x[2:]) for x in regexp_extract_all(n_name, '[A-Za-z0-9]+|[^A-Za-z0-9]+')], 'string_agg', '') AS ic FROM nation""")
register_sql("inet", "SELECT n_nationkey, inet_aton('10.0.3.' || n_nationkey::varchar) AS a, inet_ntoa(n_nationkey * 65536 + 7) AS b FROM nation", "SELECT n_nationkey, (167772160 + 768 + n_nationkey)::bigint AS a, '0.' || n_nationkey || '.0.7' AS b FROM nation")
register_sql(
    "array_functions",
    """
    SELECT c_custkey, array_length(a)::int AS n, array_to_string(a, ',') AS s, array_position(a, c_nationkey)::int AS p, array_to_string(array_append(a, 9), ',') AS ap, array_to_string(array_prepend(9, a), ',') AS pre, array_to_string(array_cat(a, ARRAY[1, 2]), ',') AS cat, array_to_string(array_remove(a, 7), ',') AS rm,
           array_to_string(array_replace(a, 7, 8), ',') AS rp, a[1] AS f, a[9] AS far, array_to_string(a[2:3], ',') AS sl, array_min(a) AS mn, array_max(a) AS mx, array_sum(a) AS sm, array_to_string(array_sort(a), ',') AS so, array_to_string(array_distinct(a), ',') AS di, cardinality(a)::int AS ca, array_dims(a) AS dims, array_to_string(trim_array(a, 1), ',') AS ta, array_to_string(array_transform(a, |x| x * 2), ',') AS tf, 7 = ANY(a) AS an
    FROM (SELECT c_custkey, c_nationkey, ARRAY[c_nationkey, 7, c_nationkey + 1] AS a FROM customer) t
    """,
    """
    SELECT c_custkey, len(a)::int AS n, array_to_string(a, ',') AS s, list_position(a, c_nationkey)::int AS p, array_to_string(list_append(a, 9), ',') AS ap, array_to_string(list_prepend(9, a), ',') AS pre, array_to_string(list_concat(a, [1, 2]), ',') AS cat, array_to_string([x for x in a if x <> 7], ',') AS rm,
           array_to_string([CASE WHEN x = 7 THEN 8 ELSE x END for x in a], ',') AS rp, a[1] AS f, NULL::int AS far, array_to_string(a[2:3], ',') AS sl, list_min(a) AS mn, list_max(a) AS mx, list_sum(a)::int AS sm, array_to_string(list_sort(a), ',') AS so, array_to_string(CASE WHEN c_nationkey = 7 THEN [7, 8] WHEN c_nationkey = 6 THEN [6, 7] ELSE a END, ',') AS di, len(a)::int AS ca, '[1:3]' AS dims, array_to_string(a[1:2], ',') AS ta, array_to_string([x * 2 for x in a], ',') AS tf, list_contains(a, 7) AS an
    FROM (SELECT c_custkey, c_nationkey, [c_nationkey, 7, c_nationkey + 1] AS a FROM customer) t
    """,
)
register_sql("array_containment", "SELECT c_custkey, ARRAY[c_nationkey, 7, 1] @> ARRAY[7, c_nationkey] AS up, ARRAY[c_nationkey] <@ ARRAY[1, 2, 3] AS down, array_to_string(string_to_array('a,b,' || c_nationkey::varchar, ','), '-') AS st FROM customer", "SELECT c_custkey, true AS up, c_nationkey IN (1, 2, 3) AS down, 'a-b-' || c_nationkey AS st FROM customer")
register_sql("map_functions", "SELECT n_nationkey, map_length(m)::int AS n, array_to_string(array_sort(map_keys(m)), ',') AS k, map_access(m, 'a') AS a, map_contains(m, n_name) AS c, map_length(map_delete(m, 'a'))::int AS d, map_access(map_insert(m, 'a', 5), 'a') AS i, map_access(map_cat(m, map_from_key_values(ARRAY['a'], ARRAY[77])), 'a') AS ca FROM (SELECT n_nationkey, n_name, map_from_key_values(ARRAY['a', n_name], ARRAY[1, n_nationkey]) AS m FROM nation) t", "SELECT n_nationkey, 2 AS n, CASE WHEN 'a' < n_name THEN 'a,' || n_name ELSE n_name || ',a' END AS k, 1 AS a, true AS c, 1 AS d, 5 AS i, 77 AS ca FROM nation")
register_sql(
    "json_functions",
    """
    SELECT event_id, props->>'k' AS k, props->'k' AS j, jsonb_typeof(props) AS t, (props->>'k')::int + 1 AS n, is_json(props) AS ok, jsonb_exists(props, 'k') AS ex, jsonb_exists(props, 'zz') AS no, jsonb_array_length('[1,2,3]')::int AS al, jsonb_extract_path_text('{"a":{"b":[5,6]}}', 'a', 'b', '1') AS deep, jsonb_typeof(props->'k') AS tk
    FROM events
    """,
    """SELECT event_id, props->>'k' AS k, (props->'k')::varchar AS j, 'object' AS t, (props->>'k')::int + 1 AS n, true AS ok, true AS ex, false AS no, 3 AS al, '6' AS deep, 'number' AS tk FROM events""",
)
register_sql(
    "json_building",
    """SELECT event_id, jsonb_concat(props, jsonb_build_object('z', event_id)) AS c, jsonb_delete(jsonb_build_object('a', event_id, 'b', event_type), 'a') AS d, jsonb_strip_nulls(jsonb_build_object('a', event_id, 'b', jsonb_build_object('c', nullif(event_type, 'view')))) AS s FROM events""",
    """SELECT event_id, replace(props, ': ', ':')[:-2] || ',"z":' || event_id || '}' AS c, json_object('b', event_type)::varchar AS d, CASE WHEN event_type = 'view' THEN json_object('a', event_id, 'b', '{}'::json) ELSE json_object('a', event_id, 'b', json_object('c', event_type)) END::varchar AS s FROM events""",
)
register_sql("json_table_functions", "SELECT n_nationkey, jsonb_array_elements_text(jsonb_build_array(n_name, n_nationkey)) AS e FROM nation", "SELECT n_nationkey, unnest([n_name, n_nationkey::varchar]) AS e FROM nation")
register_sql("vector_functions", "SELECT vec_id, round(l2_norm(embedding), 5) AS n, round(l2_distance(embedding, embedding), 6) AS z, round(inner_product(embedding, embedding), 5) AS ip, round(cosine_distance(embedding, embedding), 6) AS cd, round(l1_distance(embedding, embedding), 6) AS l1, size(subvector(embedding, 2, 5))::int AS sv FROM embeddings", "SELECT vec_id, round(sqrt(list_sum([x::double * x for x in embedding])), 5) AS n, 0.0::double AS z, round(list_sum([x::double * x for x in embedding]), 5) AS ip, 0.0::double AS cd, 0.0::double AS l1, 5 AS sv FROM embeddings")
register_sql(
    "aggregate_functions",
    """
    SELECT c_nationkey, count(*) AS n, count(c_mktsegment) AS nc, round(sum(c_acctbal), 2) AS s, round(avg(c_acctbal), 6) AS a, min(c_acctbal) AS mn, max(c_acctbal) AS mx, round(stddev_pop(c_acctbal), 5) AS sp, round(stddev_samp(c_acctbal), 5) AS ss, round(var_pop(c_acctbal), 3) AS vp, round(var_samp(c_acctbal), 3) AS vs,
           bit_and(c_custkey) AS ba, bit_or(c_custkey) AS bo, bit_xor(c_custkey) AS bx, bool_and(c_acctbal > -500) AS al, bool_or(c_acctbal > 9000) AS an, arg_min(c_name, c_acctbal) AS am, arg_max(c_name, c_acctbal) AS ax, string_agg(c_mktsegment, ',' ORDER BY c_custkey) AS sa, array_to_string(array_agg(c_custkey ORDER BY c_acctbal DESC, c_custkey), ',') AS aa,
           round(percentile_cont(0.5) WITHIN GROUP (ORDER BY c_acctbal), 6) AS pc, percentile_disc(0.25) WITHIN GROUP (ORDER BY c_acctbal) AS pd, mode() WITHIN GROUP (ORDER BY c_nationkey + 1) AS mo
    FROM customer GROUP BY c_nationkey
    """,
)
register_sql("approx_count_distinct", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS exact, abs(approx_count_distinct(o_custkey) - count(DISTINCT o_custkey)) <= 0.15 * count(DISTINCT o_custkey) AS near FROM orders GROUP BY o_orderpriority", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS exact, true AS near FROM orders GROUP BY o_orderpriority")
register_sql("first_last_aggregates", "SELECT o_custkey, first_value(o_orderkey ORDER BY o_totalprice) AS f, last_value(o_orderkey ORDER BY o_totalprice) AS l FROM orders GROUP BY o_custkey", "SELECT o_custkey, first(o_orderkey ORDER BY o_totalprice) AS f, last(o_orderkey ORDER BY o_totalprice) AS l FROM orders GROUP BY o_custkey")
register_sql("generate_series", "SELECT n_nationkey, generate_series(1, n_nationkey % 3) AS g FROM nation", "SELECT n_nationkey, unnest(generate_series(1, n_nationkey % 3))::int AS g FROM nation")
register_sql("unnest", "SELECT n_nationkey, unnest(ARRAY[n_nationkey, 5]) AS u FROM nation")
register_sql("comparison_predicates", "SELECT c_custkey, nullif(c_nationkey, 3) IS DISTINCT FROM 4 AS d, nullif(c_nationkey, 3) IS NOT DISTINCT FROM NULL AS e, (nullif(c_nationkey, 3) > 4) IS TRUE AS t, (nullif(c_nationkey, 3) > 4) IS NOT TRUE AS nt, (nullif(c_nationkey, 3) > 4) IS FALSE AS f, (nullif(c_nationkey, 3) > 4) IS NOT FALSE AS nf, c_nationkey BETWEEN 3 AND 9 AS b, c_mktsegment IN ('BUILDING', 'MACHINERY') AS i FROM customer")
register_sql("similar_to", "SELECT p_partkey, p_brand SIMILAR TO 'Brand#[12]%' AS s FROM part", "SELECT p_partkey, regexp_full_match(p_brand, 'Brand#[12].*') AS s FROM part")
register_sql("casts", "SELECT c_custkey, c_custkey::varchar AS s, c_acctbal::int AS i, c_nationkey::double precision AS d, (c_custkey % 2)::boolean AS b, CAST('2024-03-01' AS DATE) AS dt, '12.5'::numeric(10, 2)::double precision AS nu FROM customer", "SELECT c_custkey, c_custkey::varchar AS s, trunc(c_acctbal)::int AS i, c_nationkey::double AS d, (c_custkey % 2)::boolean AS b, DATE '2024-03-01' AS dt, 12.5::double AS nu FROM customer")
