"""Scalar function inventory (PRD, MTH, STR-F, DTM, COL, AUX-01/02).

Each id is one query over a whole table: the key columns plus one output
column per function form.  The oracle is the same projection written in SQL
with the reference semantics spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from quern.functions import scalar as S
from quern.plans.common import t
from quern.plans.registry import add

E = F.expr
col = F.col

KEYS = {
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "part": ["p_partkey"],
    "customer": ["c_custkey"],
    "orders": ["o_orderkey"],
    "pages": ["page_id"],
    "documents": ["doc_id"],
}


def scalar(name: str, table: str, cols: list[tuple[str, "Callable[[], Column]", str]],
           *, oracle: bool = True) -> None:
    keys = KEYS[table]

    def q(spark, sf):
        return t(spark, sf, table).select(*keys, *[c().alias(a) for a, c, _ in cols])

    sql = None
    if oracle:
        sql = (f"SELECT {', '.join(keys)}, "
               + ", ".join(f"{s} AS {a}" for a, _, s in cols) + f" FROM {table}")
    add(name, q, sql)


# nullable helpers used across the predicate forms
NB = "(nullif(l_linenumber, 1) > 3)"          # a nullable boolean
nb = lambda: E(NB)

# --- 2.11 predicates ------------------------------------------------------
scalar("prd_01_equals", "lineitem", [
    ("eq", lambda: col("l_quantity") == 10, "l_quantity = 10"),
    ("eq_null", lambda: E("nullif(l_linenumber, 1)") == 2, "nullif(l_linenumber, 1) = 2")])
scalar("prd_02_not_equals", "lineitem", [
    ("ne", lambda: col("l_returnflag") != "N", "l_returnflag <> 'N'")])
scalar("prd_03_greater", "lineitem", [
    ("gt", lambda: col("l_quantity") > 25, "l_quantity > 25"),
    ("ge", lambda: col("l_quantity") >= 25, "l_quantity >= 25")])
scalar("prd_04_less", "lineitem", [
    ("lt", lambda: col("l_discount") < 0.05, "l_discount < 0.05::DOUBLE"),
    ("le", lambda: col("l_discount") <= 0.05, "l_discount <= 0.05::DOUBLE")])
scalar("prd_05_is_distinct_from", "lineitem", [
    ("d", lambda: ~E("nullif(l_linestatus, 'O')").eqNullSafe(E("nullif(l_returnflag, 'N')")),
     "nullif(l_linestatus, 'O') IS DISTINCT FROM nullif(l_returnflag, 'N')")])
scalar("prd_06_is_not_distinct_from", "lineitem", [
    ("nd", lambda: E("nullif(l_linestatus, 'O')").eqNullSafe(E("nullif(l_returnflag, 'N')")),
     "nullif(l_linestatus, 'O') IS NOT DISTINCT FROM nullif(l_returnflag, 'N')")])
scalar("prd_07_is_null", "lineitem", [
    ("isnull", lambda: E("nullif(l_linenumber, 1)").isNull(), "nullif(l_linenumber, 1) IS NULL"),
    ("notnull", lambda: E("nullif(l_linenumber, 1)").isNotNull(), "nullif(l_linenumber, 1) IS NOT NULL")])
scalar("prd_08_is_true_false_unknown", "lineitem", [
    ("is_true", lambda: S.is_true(nb()), f"coalesce({NB}, false)"),
    ("is_not_true", lambda: S.is_not_true(nb()), f"NOT coalesce({NB}, false)"),
    ("is_false", lambda: S.is_false(nb()), f"coalesce(NOT {NB}, false)"),
    ("is_not_false", lambda: S.is_not_false(nb()), f"NOT coalesce(NOT {NB}, false)"),
    ("is_unknown", lambda: S.is_unknown(nb()), f"{NB} IS NULL")])
scalar("prd_09_and_or_not", "lineitem", [
    ("a", lambda: nb() & (col("l_quantity") > 25), f"{NB} AND l_quantity > 25"),
    ("o", lambda: nb() | (col("l_quantity") > 25), f"{NB} OR l_quantity > 25"),
    ("n", lambda: ~nb(), f"NOT {NB}")])
scalar("prd_10_between", "lineitem", [
    ("b", lambda: col("l_quantity").between(10, 20), "l_quantity BETWEEN 10 AND 20"),
    ("nb", lambda: ~col("l_quantity").between(10, 20), "l_quantity NOT BETWEEN 10 AND 20")])
scalar("prd_11_between_symmetric", "lineitem", [
    ("bs", lambda: S.between_symmetric("l_quantity", F.lit(20), F.lit(10)), "l_quantity BETWEEN 10 AND 20")])
scalar("prd_12_in", "lineitem", [
    ("in_list", lambda: col("l_linenumber").isin(1, 3, 5), "l_linenumber IN (1, 3, 5)"),
    ("not_in_null", lambda: ~col("l_linenumber").isin(1, None), "l_linenumber NOT IN (1, NULL)")])
scalar("prd_14_like", "part", [
    ("l1", lambda: col("p_brand").like("Brand#1_"), "p_brand LIKE 'Brand#1_'"),
    ("l2", lambda: col("p_name").like("%e_t%"), "p_name LIKE '%e_t%'"),
    ("l3", lambda: ~col("p_type").like("%OM%"), "p_type NOT LIKE '%OM%'"),
    ("l4", lambda: F.like(col("p_type"), F.lit("ECON!%%"), F.lit("!")), "p_type LIKE 'ECON!%%' ESCAPE '!'")])
scalar("prd_15_similar_to", "part", [
    ("s1", lambda: S.similar_to("p_name", "(small|red)%"), "regexp_full_match(p_name, '(small|red).*')"),
    ("s2", lambda: ~S.similar_to("p_brand", "Brand#[0-9]"), "NOT regexp_full_match(p_brand, 'Brand#[0-9]')")])
scalar("prd_16_overlaps", "orders", [
    ("ov", lambda: S.overlaps(col("o_orderdate"), col("o_orderdate") + E("INTERVAL 30 DAYS"),
                      E("TIMESTAMP_NTZ'1996-01-01 00:00:00'"), E("TIMESTAMP_NTZ'1996-03-01 00:00:00'")),
     "o_orderdate <= TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-01-01' <= o_orderdate + INTERVAL 30 DAY")])
scalar("prd_17_case", "lineitem", [
    ("searched", lambda: F.when(col("l_quantity") < 10, "low").when(col("l_quantity") < 30, "mid").otherwise("high"),
     "CASE WHEN l_quantity < 10 THEN 'low' WHEN l_quantity < 30 THEN 'mid' ELSE 'high' END"),
    ("simple", lambda: F.when(col("l_returnflag") == "R", 1).when(col("l_returnflag") == "A", 2),
     "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 END")])
scalar("prd_18_if", "lineitem", [
    ("i", lambda: F.when(col("l_quantity") > 25, F.lit("big")).otherwise(F.lit("small")),
     "if(l_quantity > 25, 'big', 'small')")])
scalar("prd_19_coalesce", "lineitem", [
    ("c", lambda: F.coalesce(E("nullif(l_returnflag, 'N')"), col("l_linestatus")),
     "coalesce(nullif(l_returnflag, 'N'), l_linestatus)")])
scalar("prd_20_nullif", "lineitem", [
    ("n", lambda: F.nullif(col("l_returnflag"), F.lit("N")), "nullif(l_returnflag, 'N')")])
scalar("prd_21_cast", "lineitem", [
    ("to_long", lambda: col("l_extendedprice").cast("long"), "trunc(l_extendedprice)::BIGINT"),
    ("to_str", lambda: col("l_linenumber").cast("string"), "l_linenumber::VARCHAR"),
    ("try_int", lambda: col("l_returnflag").try_cast("int"), "TRY_CAST(l_returnflag AS INTEGER)")])
_num_text = lambda: E("regexp_extract(props, ':\\\\s*([^}]*)', 1)")
scalar("prd_23_is_decimal", "events", [
    ("d1", lambda: S.is_decimal(_num_text()), "regexp_full_match(regexp_extract(props, ':\\s*([^}]*)', 1), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')"),
    ("d2", lambda: S.is_decimal(col("value").cast("string")), "true"),
    ("d3", lambda: S.is_decimal(col("event_type")), "false")])
scalar("prd_24_is_digit", "events", [
    ("g1", lambda: S.is_digit(_num_text()), "regexp_full_match(regexp_extract(props, ':\\s*([^}]*)', 1), '[0-9]+')"),
    ("g2", lambda: S.is_digit(col("value").cast("string")), "false")])
scalar("prd_25_is_alpha", "events", [
    ("a1", lambda: S.is_alpha(col("event_type")), "regexp_full_match(event_type, '\\p{L}+')"),
    ("a2", lambda: S.is_alpha(col("props")), "false")])

# --- 2.12 math ---------------------------------------------------------------
scalar("mth_01_arithmetic", "lineitem", [
    ("disc_price", lambda: F.round(col("l_extendedprice") * (1 - col("l_discount")), 4),
     "round(l_extendedprice * (1 - l_discount), 4)"),
    ("plus", lambda: F.round(col("l_quantity") + col("l_tax"), 4), "round(l_quantity + l_tax, 4)"),
    ("minus", lambda: (col("l_quantity") - col("l_linenumber")), "l_quantity - l_linenumber")])
scalar("mth_02_unary", "lineitem", [
    ("neg", lambda: -col("l_quantity"), "-l_quantity"), ("pos", lambda: F.positive(col("l_tax")), "+l_tax")])
scalar("mth_03_divide", "lineitem", [
    ("int_div", lambda: S.int_divide("l_linenumber", F.lit(2)), "(l_linenumber // 2)::BIGINT"),
    ("dbl_div", lambda: col("l_extendedprice") / col("l_quantity"), "l_extendedprice / l_quantity")])
scalar("mth_04_integer_divide", "lineitem", [
    ("q", lambda: E("l_orderkey div 7"), "l_orderkey // 7")])
scalar("mth_05_mod", "lineitem", [
    ("m", lambda: (col("l_linenumber") - 4) % 3, "(l_linenumber - 4) % 3")])
scalar("mth_06_abs", "lineitem", [("a", lambda: F.abs(col("l_linenumber") - 4), "abs(l_linenumber - 4)")])
scalar("mth_07_sign", "lineitem", [
    ("s", lambda: F.signum(col("l_linenumber") - 4), "sign(l_linenumber - 4)::DOUBLE")])
scalar("mth_08_ceil_floor", "lineitem", [
    ("c", lambda: F.ceil(col("l_extendedprice") / 100), "ceil(l_extendedprice / 100)::BIGINT"),
    ("f", lambda: F.floor(col("l_extendedprice") / 100), "floor(l_extendedprice / 100)::BIGINT")])
_dec = lambda: E("cast(l_extendedprice as decimal(18, 4))")
scalar("mth_09_round", "lineitem", [
    ("r1", lambda: F.round(_dec(), 1).cast("double"), "round(l_extendedprice::DECIMAL(18,4), 1)::DOUBLE"),
    ("r0", lambda: F.round(_dec(), 0).cast("double"), "round(l_extendedprice::DECIMAL(18,4), 0)::DOUBLE"),
    ("rn", lambda: F.round(_dec(), -2).cast("double"), "round(l_extendedprice::DECIMAL(18,4), -2)::DOUBLE")])
scalar("mth_10_truncate", "lineitem", [
    ("t1", lambda: S.truncate(_dec(), 1).cast("double"), "(trunc(l_extendedprice::DECIMAL(18,4) * 10) / 10)::DOUBLE"),
    ("tneg", lambda: S.truncate(-_dec(), 1).cast("double"), "(trunc(-l_extendedprice::DECIMAL(18,4) * 10) / 10)::DOUBLE")])
scalar("mth_11_power_sqrt_exp", "lineitem", [
    ("p", lambda: F.round(F.pow(col("l_quantity"), 2), 6), "round(power(l_quantity, 2), 6)"),
    ("s", lambda: F.round(F.sqrt(col("l_extendedprice")), 6), "round(sqrt(l_extendedprice), 6)"),
    ("e", lambda: F.round(F.exp(col("l_discount")), 6), "round(exp(l_discount), 6)")])
scalar("mth_12_ln_log10_log2", "lineitem", [
    ("ln", lambda: F.round(F.ln(col("l_extendedprice")), 6), "round(ln(l_extendedprice), 6)"),
    ("l10", lambda: F.round(F.log10(col("l_extendedprice")), 6), "round(log10(l_extendedprice), 6)"),
    ("l2", lambda: F.round(F.log2(col("l_extendedprice")), 6), "round(log2(l_extendedprice), 6)")])
scalar("mth_13_log", "lineitem", [
    ("l1", lambda: F.round(F.log(col("l_extendedprice")), 6), "round(ln(l_extendedprice), 6)"),
    ("lb", lambda: F.round(F.log(3.0, col("l_extendedprice")), 6), "round(ln(l_extendedprice) / ln(3.0), 6)")])
_x = lambda: col("l_discount") + 0.1
scalar("mth_14_trig", "lineitem", [
    ("sin", lambda: F.round(F.sin(_x()), 6), "round(sin(l_discount + 0.1), 6)"),
    ("cos", lambda: F.round(F.cos(_x()), 6), "round(cos(l_discount + 0.1), 6)"),
    ("tan", lambda: F.round(F.tan(_x()), 6), "round(tan(l_discount + 0.1), 6)"),
    ("cot", lambda: F.round(F.cot(_x()), 6), "round(cot(l_discount + 0.1), 6)")])
scalar("mth_15_inverse_trig", "lineitem", [
    ("asin", lambda: F.round(F.asin(col("l_discount")), 6), "round(asin(l_discount), 6)"),
    ("acos", lambda: F.round(F.acos(col("l_discount")), 6), "round(acos(l_discount), 6)"),
    ("atan", lambda: F.round(F.atan(col("l_discount")), 6), "round(atan(l_discount), 6)"),
    ("atan2", lambda: F.round(F.atan2(col("l_tax"), _x()), 6), "round(atan2(l_tax, l_discount + 0.1), 6)")])
scalar("mth_16_hyperbolic", "lineitem", [
    ("sinh", lambda: F.round(F.sinh(col("l_discount")), 6), "round(sinh(l_discount), 6)"),
    ("cosh", lambda: F.round(F.cosh(col("l_discount")), 6), "round(cosh(l_discount), 6)"),
    ("tanh", lambda: F.round(F.tanh(col("l_discount")), 6), "round(tanh(l_discount), 6)")])
scalar("mth_17_degrees_radians", "lineitem", [
    ("deg", lambda: F.round(F.degrees(col("l_discount")), 6), "round(degrees(l_discount), 6)"),
    ("rad", lambda: F.round(F.radians(col("l_quantity")), 6), "round(radians(l_quantity), 6)")])
scalar("mth_18_pi_e", "lineitem", [
    ("pi", lambda: F.round(col("l_quantity") * F.pi(), 6), "round(l_quantity * pi(), 6)"),
    ("e", lambda: F.round(col("l_quantity") * F.e(), 6), "round(l_quantity * exp(1), 6)")])
scalar("mth_19_rand", "lineitem", [
    ("in_range", lambda: (F.rand(7) >= 0) & (F.rand(7) < 1), "true")])
scalar("mth_20_rand_integer", "lineitem", [
    ("in_range", lambda: S.rand_integer(10, 7).between(0, 9), "true")])
scalar("mth_21_bin", "lineitem", [("b", lambda: F.bin(col("l_linenumber")), "bin(l_linenumber)")])
scalar("mth_22_hex", "lineitem", [
    ("hi", lambda: F.hex(col("l_orderkey")), "hex(l_orderkey)"),
    ("hs", lambda: F.hex(col("l_returnflag")), "hex(l_returnflag)")])
_H = ("list_reduce(list_transform(string_split(p_name, ''), lambda c: unicode(c)::BIGINT), "
      "lambda acc, x: (acc * 31 + x) % 4294967296, 0::BIGINT)")
scalar("mth_23_hash_code", "part", [
    ("h", lambda: S.hash_code("p_name"),
     f"(CASE WHEN {_H} >= 2147483648 THEN {_H} - 4294967296 ELSE {_H} END)::INTEGER")])

# --- 2.13 strings ---------------------------------------------------------------
NT = "nullif(p_type, 'ECONOMY')"
scalar("str_f_01_concat_op", "part", [
    ("c", lambda: F.concat(col("p_brand"), F.lit("-"), col("p_type")), "p_brand || '-' || p_type")])
scalar("str_f_02_concat", "part", [
    ("c", lambda: F.concat(col("p_name"), E(NT)), f"p_name || {NT}")])
scalar("str_f_03_concat_ws", "part", [
    ("c", lambda: F.concat_ws("-", col("p_name"), E(NT), col("p_brand")), f"concat_ws('-', p_name, {NT}, p_brand)")])
scalar("str_f_04_char_length", "documents", [
    ("n", lambda: F.char_length(col("text")).cast("long"), "length(text)::BIGINT")])
scalar("str_f_05_upper_lower", "customer", [
    ("u", lambda: F.upper(col("c_name")), "upper(c_name)"), ("l", lambda: F.lower(col("c_mktsegment")), "lower(c_mktsegment)")])
_IC = ("array_to_string(list_transform(regexp_extract_all(p_type || '-' || p_name, '([\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+)', 1), "
       "lambda w: CASE WHEN regexp_matches(w, '^[\\p{L}\\p{N}]') THEN upper(w[1]) || lower(w[2:]) ELSE w END), '')")
scalar("str_f_06_initcap", "part", [
    ("ic", lambda: S.initcap(F.concat(col("p_type"), F.lit("-"), col("p_name"))), _IC)])
scalar("str_f_07_substring", "part", [
    ("s1", lambda: F.substring(col("p_name"), 2, 3), "substr(p_name, 2, 3)"),
    ("s0", lambda: F.substring(col("p_name"), 0, 3), "substr(p_name, 1, 3)"),
    ("sneg", lambda: F.substring(col("p_name"), -3, 2), "substr(p_name, length(p_name) - 2, 2)")])
scalar("str_f_08_left_right", "part", [
    ("l", lambda: F.left(col("p_name"), F.lit(3)), "left(p_name, 3)"),
    ("r", lambda: F.right(col("p_name"), F.lit(3)), "right(p_name, 3)")])
scalar("str_f_09_trim", "part", [
    ("both", lambda: F.btrim(col("p_brand"), F.lit("B2")), "trim(p_brand, 'B2')"),
    ("lead", lambda: F.ltrim(col("p_brand"), F.lit("Br")), "ltrim(p_brand, 'Br')"),
    ("trail", lambda: F.rtrim(col("p_brand"), F.lit("0123456789")), "rtrim(p_brand, '0123456789')")])
scalar("str_f_10_ltrim_rtrim", "part", [
    ("l", lambda: F.ltrim(F.concat(F.lit("  "), col("p_name"))), "ltrim('  ' || p_name)"),
    ("r", lambda: F.rtrim(F.concat(col("p_name"), F.lit("  "))), "rtrim(p_name || '  ')")])
scalar("str_f_11_lpad_rpad", "part", [
    ("l", lambda: F.lpad(col("p_name"), 12, "*"), "lpad(p_name, 12, '*')"),
    ("r", lambda: F.rpad(col("p_name"), 8, "#"), "rpad(p_name, 8, '#')")])
scalar("str_f_12_repeat", "lineitem", [("r", lambda: F.repeat(col("l_returnflag"), 3), "repeat(l_returnflag, 3)")])
scalar("str_f_13_reverse", "part", [("r", lambda: F.reverse(col("p_name")), "reverse(p_name)")])
scalar("str_f_14_replace", "part", [("r", lambda: F.replace(col("p_name"), F.lit(" "), F.lit("_")), "replace(p_name, ' ', '_')")])
scalar("str_f_15_overlay", "part", [
    ("o", lambda: S.overlay("p_name", "XX", 2, 3), "substr(p_name, 1, 1) || 'XX' || substr(p_name, 5)")])
scalar("str_f_16_position", "part", [
    ("p", lambda: F.position(F.lit("e"), col("p_name")).cast("long"), "position('e' IN p_name)::BIGINT")])
scalar("str_f_17_locate", "part", [
    ("l", lambda: F.locate("e", col("p_name"), 3).cast("long"),
     "(CASE WHEN instr(substr(p_name, 3), 'e') = 0 THEN 0 ELSE instr(substr(p_name, 3), 'e') + 2 END)::BIGINT")])
scalar("str_f_18_instr", "part", [
    ("i1", lambda: F.instr(col("p_name"), "e").cast("long"), "instr(p_name, 'e')::BIGINT"),
    ("i2", lambda: S.instr("p_name", "e", 1, 2).cast("long"),
     "(CASE WHEN length(p_name) - length(replace(p_name, 'e', '')) >= 2 "
     "THEN length(split_part(p_name, 'e', 1)) + length(split_part(p_name, 'e', 2)) + 2 ELSE 0 END)::BIGINT")])
scalar("str_f_19_split_index", "pages", [
    ("host", lambda: S.split_index("url", "/", 2), "string_split(url, '/')[3]"),
    ("seg", lambda: S.split_index("url", "/", 4), "string_split(url, '/')[5]"),
    ("none", lambda: S.split_index("url", "/", 9), "string_split(url, '/')[10]")])
scalar("str_f_20_regexp", "pages", [
    ("has_query", lambda: col("url").rlike(r"\?"), "regexp_matches(url, '\\?')"),
    ("https", lambda: col("url").rlike("^https"), "regexp_matches(url, '^https')")])
_RQ = r"\?([^#]*)"
scalar("str_f_21_regexp_extract", "pages", [
    ("q", lambda: S.regexp_extract_or_null("url", _RQ, 1),
     "CASE WHEN regexp_matches(url, '\\?([^#]*)') THEN regexp_extract(url, '\\?([^#]*)', 1) END"),
    ("tld", lambda: S.regexp_extract_or_null("url", r"\.(com|net|org)/", 1),
     "CASE WHEN regexp_matches(url, '\\.(com|net|org)/') THEN regexp_extract(url, '\\.(com|net|org)/', 1) END")])
scalar("str_f_22_regexp_replace", "part", [
    ("r", lambda: F.regexp_replace(col("p_name"), "[aeiou]", "*"), "regexp_replace(p_name, '[aeiou]', '*', 'g')")])
_QS = "CASE WHEN regexp_matches(url, '\\?([^#]*)') THEN regexp_extract(url, '\\?([^#]*)', 1) END"
_m = lambda: S.str_to_map(S.regexp_extract_or_null("url", _QS and _RQ, 1), "&", "=")
scalar("str_f_23_str_to_map", "pages", [
    ("page", lambda: F.element_at(_m(), F.lit("page")),
     f"CASE WHEN regexp_matches({_QS}, '(^|&)page=') THEN regexp_extract({_QS}, '(^|&)page=([^&]*)', 2) END"),
    ("n", lambda: F.size(_m()).cast("long"),
     f"CASE WHEN {_QS} IS NULL THEN NULL ELSE len(string_split({_QS}, '&')) END::BIGINT")])
scalar("str_f_24_parse_url", "pages", [
    ("protocol", lambda: S.parse_url("url", "PROTOCOL"), "regexp_extract(url, '^([a-z]+)://', 1)"),
    ("host", lambda: S.parse_url("url", "HOST"), "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"),
    ("authority", lambda: S.parse_url("url", "AUTHORITY"), "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"),
    ("path", lambda: S.parse_url("url", "PATH"), "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"),
    ("query", lambda: S.parse_url("url", "QUERY"), "nullif(regexp_extract(url, '\\?([^#]*)', 1), '')"),
    ("ref", lambda: S.parse_url("url", "REF"), "nullif(regexp_extract(url, '#(.*)$', 1), '')"),
    ("file", lambda: S.parse_url("url", "FILE"),
     "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) || coalesce('?' || nullif(regexp_extract(url, '\\?([^#]*)', 1), ''), '')"),
    ("userinfo", lambda: S.parse_url("url", "USERINFO"), "NULL::VARCHAR"),
    ("page", lambda: S.parse_url("url", "QUERY", "page"), "nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '')")])
scalar("str_f_25_ascii_chr", "lineitem", [
    ("a", lambda: F.ascii(col("l_returnflag")).cast("long"), "ascii(l_returnflag)::BIGINT"),
    ("c", lambda: F.chr(col("l_linenumber") + 64), "chr((l_linenumber + 64)::INTEGER)")])
scalar("str_f_26_encode_decode", "customer", [
    ("rt", lambda: F.decode(F.encode(col("c_name"), "UTF-8"), "UTF-8"), "decode(encode(c_name))"),
    ("nbytes", lambda: F.octet_length(F.encode(col("c_name"), "UTF-8")).cast("long"), "octet_length(encode(c_name))::BIGINT")])
scalar("str_f_27_base64", "part", [
    ("b", lambda: F.base64(col("p_name")), "to_base64(encode(p_name))"),
    ("rt", lambda: F.unbase64(F.base64(col("p_name"))).cast("string"), "decode(from_base64(to_base64(encode(p_name))))")])
scalar("str_f_28_uuid", "part", [
    ("ok", lambda: (F.length(F.uuid()) == 36) & F.uuid().rlike("^[0-9a-f-]+$"), "true")])
scalar("str_f_29_md5", "part", [("h", lambda: F.md5(col("p_name")), "md5(p_name)")])
scalar("str_f_30_sha1", "part", [("h", lambda: F.sha1(col("p_name")), "sha1(p_name)")])
scalar("str_f_31_sha224_to_512", "part", [
    ("h224", lambda: F.sha2(col("p_name"), 224), ""), ("h256", lambda: F.sha2(col("p_name"), 256), ""),
    ("h384", lambda: F.sha2(col("p_name"), 384), ""), ("h512", lambda: F.sha2(col("p_name"), 512), "")],
    oracle=False)
scalar("str_f_32_sha2", "part", [("h", lambda: F.sha2(col("p_name"), 256), "sha256(p_name)")])

# --- 2.14 date and time ---------------------------------------------------------
scalar("dtm_01_current_date_time", "events", [
    ("ok", lambda: (F.current_date() >= F.lit("2024-01-01").cast("date"))
           & F.current_timestamp().isNotNull(), "true")])
scalar("dtm_02_localtime", "events", [
    ("ok", lambda: F.localtimestamp().isNotNull(), "true")])
scalar("dtm_03_now", "events", [("ok", lambda: F.now() >= col("ts").cast("timestamp"), "true")])
scalar("dtm_04_proctime", "events", [("ok", lambda: F.current_timestamp().isNotNull(), "true")])
scalar("dtm_05_rowtime", "events", [("rowtime", lambda: col("ts"), "ts")])
scalar("dtm_06_extract", "events", [
    ("y", lambda: S.extract("YEAR", "ts"), "year(ts)::BIGINT"),
    ("q", lambda: S.extract("QUARTER", "ts"), "quarter(ts)::BIGINT"),
    ("mo", lambda: S.extract("MONTH", "ts"), "month(ts)::BIGINT"),
    ("wk", lambda: S.extract("WEEK", "ts"), "week(ts)::BIGINT"),
    ("d", lambda: S.extract("DAY", "ts"), "day(ts)::BIGINT"),
    ("dow", lambda: S.extract("DOW", "ts"), "(dayofweek(ts) + 1)::BIGINT"),
    ("doy", lambda: S.extract("DOY", "ts"), "dayofyear(ts)::BIGINT"),
    ("h", lambda: S.extract("HOUR", "ts"), "hour(ts)::BIGINT"),
    ("mi", lambda: S.extract("MINUTE", "ts"), "minute(ts)::BIGINT"),
    ("s", lambda: S.extract("SECOND", "ts"), "second(ts)::BIGINT"),
    ("ep", lambda: S.extract("EPOCH", "ts"), "floor(epoch(ts))::BIGINT"),
    ("dec", lambda: S.extract("DECADE", "ts"), "(year(ts) // 10)::BIGINT"),
    ("cen", lambda: S.extract("CENTURY", "ts"), "((year(ts) + 99) // 100)::BIGINT"),
    ("mil", lambda: S.extract("MILLENNIUM", "ts"), "((year(ts) + 999) // 1000)::BIGINT")])
scalar("dtm_07_year_quarter_month_week", "orders", [
    ("y", lambda: F.year("o_orderdate").cast("long"), "year(o_orderdate)::BIGINT"),
    ("q", lambda: F.quarter("o_orderdate").cast("long"), "quarter(o_orderdate)::BIGINT"),
    ("m", lambda: F.month("o_orderdate").cast("long"), "month(o_orderdate)::BIGINT"),
    ("w", lambda: F.weekofyear("o_orderdate").cast("long"), "week(o_orderdate)::BIGINT")])
scalar("dtm_08_dayofyear_month_week", "orders", [
    ("doy", lambda: F.dayofyear("o_orderdate").cast("long"), "dayofyear(o_orderdate)::BIGINT"),
    ("dom", lambda: F.dayofmonth("o_orderdate").cast("long"), "day(o_orderdate)::BIGINT"),
    ("dow", lambda: F.dayofweek("o_orderdate").cast("long"), "(dayofweek(o_orderdate) + 1)::BIGINT")])
scalar("dtm_09_hour_minute_second", "events", [
    ("h", lambda: F.hour("ts").cast("long"), "hour(ts)::BIGINT"),
    ("m", lambda: F.minute("ts").cast("long"), "minute(ts)::BIGINT"),
    ("s", lambda: F.second("ts").cast("long"), "second(ts)::BIGINT")])
scalar("dtm_10_floor_ceil_time", "events", [
    ("fl", lambda: S.floor_to("ts", "hour"), "date_trunc('hour', ts)"),
    ("ce", lambda: S.ceil_to("ts", "hour"),
     "CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END"),
    ("fd", lambda: S.floor_to("ts", "day"), "date_trunc('day', ts)")])
scalar("dtm_11_timestampadd", "events", [
    ("d3", lambda: F.timestamp_add("DAY", F.lit(3), col("ts")), "ts + INTERVAL 3 DAY"),
    ("m1", lambda: F.timestamp_add("MONTH", F.lit(1), col("ts")), "ts + INTERVAL 1 MONTH"),
    ("h5", lambda: F.timestamp_add("HOUR", F.lit(-5), col("ts")), "ts - INTERVAL 5 HOUR")])
_T2K = "TIMESTAMP_NTZ'2000-01-01 00:00:00'"
scalar("dtm_12_timestampdiff", "orders", [
    ("dd", lambda: F.timestamp_diff("DAY", col("o_orderdate"), E(_T2K)), "date_sub('day', o_orderdate, TIMESTAMP '2000-01-01')"),
    ("mm", lambda: F.timestamp_diff("MONTH", col("o_orderdate"), E(_T2K)), "date_sub('month', o_orderdate, TIMESTAMP '2000-01-01')"),
    ("hh", lambda: F.timestamp_diff("HOUR", col("o_orderdate"), E(_T2K)), "date_sub('hour', o_orderdate, TIMESTAMP '2000-01-01')")])
scalar("dtm_13_datetime_plus_interval", "events", [
    ("dt", lambda: col("ts") + E("INTERVAL '90' MINUTE"), "ts + INTERVAL 90 MINUTE"),
    ("ym", lambda: col("ts") + E("INTERVAL '1-2' YEAR TO MONTH"), "ts + INTERVAL 14 MONTH")])
_D = "(ts - TIMESTAMP_NTZ'2024-01-01 00:00:00')"
scalar("dtm_14_datetime_minus_datetime", "events", [
    ("days", lambda: E(f"extract(DAY FROM {_D})").cast("long"), "extract(day FROM ts - TIMESTAMP '2024-01-01')::BIGINT"),
    ("hours", lambda: E(f"extract(HOUR FROM {_D})").cast("long"), "extract(hour FROM ts - TIMESTAMP '2024-01-01')::BIGINT")])
scalar("dtm_15_date_format", "events", [
    ("f1", lambda: F.date_format("ts", "yyyy-MM-dd HH:mm"), "strftime(ts, '%Y-%m-%d %H:%M')"),
    ("f2", lambda: F.date_format("ts", "yyyyMMdd"), "strftime(ts, '%Y%m%d')")])
scalar("dtm_16_to_date", "events", [
    ("d", lambda: S.to_date_or_null(F.date_format("ts", "yyyy/MM/dd"), "yyyy/MM/dd"),
     "strptime(strftime(ts, '%Y/%m/%d'), '%Y/%m/%d')::DATE"),
    ("bad", lambda: S.to_date_or_null(col("event_type"), "yyyy-MM-dd"), "NULL::DATE")])
scalar("dtm_17_to_timestamp", "events", [
    ("t", lambda: S.to_timestamp_or_null(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
     "date_trunc('second', ts)"),
    ("bad", lambda: S.to_timestamp_or_null(col("event_type")), "NULL::TIMESTAMP")])
scalar("dtm_18_unix_timestamp", "events", [
    ("u", lambda: F.unix_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss"),
     "floor(epoch(ts))::BIGINT")])
scalar("dtm_19_from_unixtime", "events", [
    ("f", lambda: F.from_unixtime(S.epoch_seconds("ts"), "yyyy-MM-dd HH:mm:ss"), "strftime(ts, '%Y-%m-%d %H:%M:%S')")])
scalar("dtm_20_convert_tz", "events", [
    ("c", lambda: S.convert_tz(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "UTC", "Asia/Shanghai"),
     "strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')")])

# --- 2.15 collections -----------------------------------------------------------
_arr = lambda: F.array(col("l_linenumber"), col("l_orderkey").cast("int"))
scalar("col_01_array", "lineitem", [
    ("a", lambda: F.array_join(_arr(), ","), "array_to_string([l_linenumber, l_orderkey::INTEGER], ',')"),
    ("n", lambda: F.size(_arr()).cast("long"), "2::BIGINT")])
_map = lambda: F.create_map(F.lit("line"), col("l_linenumber"), F.lit("qty"), col("l_quantity").cast("int"))
scalar("col_02_map", "lineitem", [
    ("qty", lambda: _map()["qty"], "l_quantity::INTEGER"),
    ("n", lambda: F.size(_map()).cast("long"), "2::BIGINT")])
_row = lambda: F.struct(col("l_returnflag").alias("flag"), col("l_linestatus").alias("status"))
scalar("col_03_row", "lineitem", [
    ("flag", lambda: _row()["flag"], "l_returnflag"), ("status", lambda: _row()["status"], "l_linestatus")])
scalar("col_04_item_access", "lineitem", [
    ("second", lambda: F.try_element_at(_arr(), F.lit(2)), "l_orderkey::INTEGER"),
    ("oob", lambda: F.try_element_at(_arr(), F.lit(5)), "NULL::INTEGER"),
    ("by_key", lambda: F.try_element_at(_map(), F.lit("line")), "l_linenumber")])
scalar("col_05_cardinality", "lineitem", [
    ("n", lambda: F.cardinality(F.filter(_arr(), lambda x: x > 3)).cast("long"),
     "((l_linenumber > 3)::INTEGER + (l_orderkey > 3)::INTEGER)::BIGINT")])
scalar("col_06_element", "lineitem", [
    ("e", lambda: S.element(F.filter(F.array(col("l_linenumber")), lambda x: x > 3)),
     "CASE WHEN l_linenumber > 3 THEN l_linenumber END")])
scalar("col_07_field_access", "lineitem", [
    ("ln", lambda: F.struct(col("l_orderkey"), F.struct(col("l_linenumber").alias("ln")).alias("inner"))["inner"]["ln"],
     "l_linenumber")])
_ms = lambda: S.multiset(col("l_returnflag"), col("l_linestatus"), col("l_returnflag"))
scalar("col_08_multiset", "lineitem", [
    ("n_flag", lambda: _ms()[col("l_returnflag")].cast("long"),
     "(CASE WHEN l_returnflag = l_linestatus THEN 3 ELSE 2 END)::BIGINT"),
    ("n_distinct", lambda: F.size(_ms()).cast("long"),
     "(CASE WHEN l_returnflag = l_linestatus THEN 1 ELSE 2 END)::BIGINT")])

# --- 2.16 sort modifiers -------------------------------------------------------
_w_desc = lambda: Window.partitionBy("l_orderkey").orderBy(col("l_quantity").desc(), "l_linenumber", "l_partkey", "l_suppkey")
_nq = lambda: E("nullif(l_quantity, 1.0)")
scalar("aux_01_desc", "lineitem", [
    ("rn", lambda: F.rank().over(_w_desc()).cast("long"),
     "rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey)")])
scalar("aux_02_nulls_first_last", "lineitem", [
    ("rn_nf", lambda: F.rank().over(Window.partitionBy("l_orderkey").orderBy(_nq().asc_nulls_first(), "l_linenumber", "l_partkey", "l_suppkey")).cast("long"),
     "rank() OVER (PARTITION BY l_orderkey ORDER BY nullif(l_quantity, 1.0) ASC NULLS FIRST, l_linenumber, l_partkey, l_suppkey)"),
    ("rn_nl", lambda: F.rank().over(Window.partitionBy("l_orderkey").orderBy(_nq().desc_nulls_last(), "l_linenumber", "l_partkey", "l_suppkey")).cast("long"),
     "rank() OVER (PARTITION BY l_orderkey ORDER BY nullif(l_quantity, 1.0) DESC NULLS LAST, l_linenumber, l_partkey, l_suppkey)")])
