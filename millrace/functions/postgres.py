"""PostgreSQL-flavoured functions as Spark SQL expressions.

Each entry is a template over the call's arguments ({0}, {1}, ...; {*} all of them), so calls stay polymorphic and Catalyst
sees nothing but built-ins. Several templates of one name are told apart by their number of arguments. Names that mean the
same in Spark need no entry. What built-ins can't express is in ``functions.python``.
"""

from __future__ import annotations

import re

#: name -> templates
CALLS: dict[str, list[str]] = {}


def _add(text: str) -> None:
    for line in text.strip().splitlines():
        name, _, template = line.strip().partition(" = ")
        CALLS.setdefault(name, []).append(template)


# strings
_add(r"""
concat_op = concat({*})
char_length = char_length({0})
character_length = char_length({0})
length = char_length({0})
substr = CASE WHEN {1} >= 1 THEN substring({0}, {1}) ELSE {0} END
substr = CASE WHEN {1} >= 1 THEN substring({0}, {1}, {2}) ELSE substring({0}, 1, greatest({2} + {1} - 1, 0)) END
substring = CASE WHEN {1} >= 1 THEN substring({0}, {1}) ELSE {0} END
substring = CASE WHEN {1} >= 1 THEN substring({0}, {1}, {2}) ELSE substring({0}, 1, greatest({2} + {1} - 1, 0)) END
left = CASE WHEN {1} >= 0 THEN substring({0}, 1, {1}) ELSE substring({0}, 1, greatest(char_length({0}) + {1}, 0)) END
right = CASE WHEN {1} >= 0 THEN CASE WHEN {1} = 0 THEN '' ELSE substring({0}, greatest(char_length({0}) - {1}, 0) + 1) END ELSE substring({0}, 1 - {1}) END
strpos = CAST(locate({1}, {0}) AS INT)
position = CAST(locate({0}, {1}) AS INT)
starts_with = startswith({0}, {1})
btrim = trim(BOTH ' ' FROM {0})
btrim = trim(BOTH {1} FROM {0})
ltrim = trim(LEADING ' ' FROM {0})
ltrim = trim(LEADING {1} FROM {0})
rtrim = trim(TRAILING ' ' FROM {0})
rtrim = trim(TRAILING {1} FROM {0})
chr = decode(unhex(CASE WHEN {0} < 128 THEN lpad(hex({0}), 2, '0') WHEN {0} < 2048 THEN hex((192 | shiftright({0}, 6)) * 256 + (128 | ({0} & 63))) WHEN {0} < 65536 THEN hex((224 | shiftright({0}, 12)) * 65536 + (128 | (shiftright({0}, 6) & 63)) * 256 + (128 | ({0} & 63))) ELSE hex((240 | shiftright({0}, 18)) * 16777216L + (128 | (shiftright({0}, 12) & 63)) * 65536 + (128 | (shiftright({0}, 6) & 63)) * 256 + (128 | ({0} & 63))) END), 'UTF-8')
initcap = array_join(transform(regexp_extract_all({0}, '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)', 1), x -> concat(upper(substring(x, 1, 1)), lower(substring(x, 2)))), '')
to_hex = lower(hex({0}))
regexp_count = regexp_count({0}, {1})
regexp_count = regexp_count(substring({0}, {2}), {1})
regexp_count = regexp_count(substring({0}, {2}), concat('(?', {3}, ')', {1}))
regexp_split_to_array = split({0}, {1})
string_to_array = CASE WHEN {1} IS NULL THEN split({0}, '') WHEN {0} = '' THEN array() WHEN {1} = '' THEN array({0}) ELSE split({0}, concat('\\Q', {1}, '\\E')) END
string_to_array = transform(CASE WHEN {1} IS NULL THEN split({0}, '') WHEN {0} = '' THEN array() WHEN {1} = '' THEN array({0}) ELSE split({0}, concat('\\Q', {1}, '\\E')) END, x -> nullif(x, {2}))
array_to_string = array_join({0}, {1})
array_to_string = array_join({0}, {1}, {2})
bool_out = CASE WHEN {0} THEN 't' WHEN NOT {0} THEN 'f' END
quote_ident = CASE WHEN {0} RLIKE '^[a-z_][a-z0-9_$]*$' THEN {0} ELSE concat('"', replace({0}, '"', '""'), '"') END
quote_literal = concat(CASE WHEN contains({0}, '\\') THEN ' E' ELSE '' END, '''', replace(replace({0}, '''', ''''''), '\\', '\\\\'), '''')
quote_nullable = coalesce(concat('''', replace({0}, '''', ''''''), ''''), 'NULL')
md5 = md5({0})
sha1 = unhex(sha1({0}))
sha224 = unhex(sha2({0}, 224))
sha256 = unhex(sha2({0}, 256))
sha384 = unhex(sha2({0}, 384))
sha512 = unhex(sha2({0}, 512))
encode = CASE lower({1}) WHEN 'hex' THEN lower(hex({0})) WHEN 'base64' THEN replace(base64({0}), '\r\n', '\n') WHEN 'escape' THEN encode_escape({0}) END
decode = CASE lower({1}) WHEN 'hex' THEN unhex({0}) WHEN 'base64' THEN unbase64({0}) WHEN 'escape' THEN decode_escape({0}) END
convert_from = decode({0}, {1})
convert_to = encode({0}, {1})
get_byte = CAST(conv(hex(substring({0}, {1} + 1, 1)), 16, 10) AS INT)
get_bit = (shiftright(CAST(conv(hex(substring({0}, ({1} div 8) + 1, 1)), 16, 10) AS INT), {1} % 8) & 1)
bit_count = bit_count({0})
inet_aton = aggregate(transform(split({0}, '[.]'), x -> CAST(x AS BIGINT)), 0L, (s, x) -> s * 256 + x)
inet_ntoa = concat_ws('.', shiftright({0}, 24) & 255, shiftright({0}, 16) & 255, shiftright({0}, 8) & 255, {0} & 255)
secure_compare = ({0} = {1})
""")

# numbers
_add(r"""
div = ({0} div {1})
mod = ({0} % {1})
trunc = CASE WHEN {0} < 0 THEN ceil({0}) ELSE floor({0}) END
trunc = CASE WHEN {0} < 0 THEN ceil({0}, {1}) ELSE floor({0}, {1}) END
pow = power(CAST({0} AS DOUBLE), CAST({1} AS DOUBLE))
power = power(CAST({0} AS DOUBLE), CAST({1} AS DOUBLE))
log = log10({0})
log = log({0}, {1})
sign = signum({0})
coth = (1 / tanh({0}))
sind = CASE WHEN {0} % 180 = 0 THEN 0D WHEN {0} % 360 IN (30, 150, -210, -330) THEN 0.5D WHEN {0} % 360 IN (90, -270) THEN 1D WHEN {0} % 360 IN (210, 330, -30, -150) THEN -0.5D WHEN {0} % 360 IN (270, -90) THEN -1D ELSE sin(radians({0})) END
cosd = CASE WHEN {0} % 360 = 0 THEN 1D WHEN {0} % 360 IN (60, 300, -60, -300) THEN 0.5D WHEN {0} % 360 IN (90, 270, -90, -270) THEN 0D WHEN {0} % 360 IN (120, 240, -120, -240) THEN -0.5D WHEN {0} % 360 IN (180, -180) THEN -1D ELSE cos(radians({0})) END
tand = CASE WHEN {0} % 180 = 0 THEN 0D WHEN {0} % 180 IN (45, -135) THEN 1D WHEN {0} % 180 IN (135, -45) THEN -1D ELSE tan(radians({0})) END
cotd = CASE WHEN {0} % 180 IN (90, -90) THEN 0D WHEN {0} % 180 IN (45, -135) THEN 1D WHEN {0} % 180 IN (135, -45) THEN -1D ELSE 1 / tan(radians({0})) END
asind = degrees(asin({0}))
acosd = degrees(acos({0}))
atand = degrees(atan({0}))
atan2d = degrees(atan2({0}, {1}))
scale = CASE WHEN contains(CAST({0} AS STRING), '.') THEN char_length(split_part(CAST({0} AS STRING), '.', 2)) ELSE 0 END
min_scale = CASE WHEN contains(CAST({0} AS STRING), '.') THEN char_length(rtrim('0', split_part(CAST({0} AS STRING), '.', 2))) ELSE 0 END
trim_scale = CASE WHEN contains(CAST({0} AS STRING), '.') THEN rtrim('.', rtrim('0', CAST({0} AS STRING))) ELSE CAST({0} AS STRING) END
random = rand()
check_not_null = coalesce({0}, raise_error('a column that must not be null is null'))
""")

# dates and times
_add(r"""
date_part = EXTRACT({0} FROM {1})
make_timestamp = make_timestamp_ntz({*})
make_time = rtrim('.', rtrim('0', date_format(make_timestamp_ntz(2000, 1, 1, {0}, {1}, {2}), 'HH:mm:ss.SSSSSS')))
make_timestamptz = make_timestamp_ltz({*})
to_timestamp = timestamp_seconds({0})
to_timestamp = to_timestamp({0}, {1:pattern})
to_date = to_date({0}, {1:pattern})
date_bin = timestamp_micros(unix_micros(CAST({2} AS TIMESTAMP)) + CAST(floor((unix_micros(CAST({1} AS TIMESTAMP)) - unix_micros(CAST({2} AS TIMESTAMP))) / (unix_micros(TIMESTAMP '2000-01-03 00:00:00' + {0}) - unix_micros(TIMESTAMP '2000-01-03 00:00:00'))) AS BIGINT) * (unix_micros(TIMESTAMP '2000-01-03 00:00:00' + {0}) - unix_micros(TIMESTAMP '2000-01-03 00:00:00')))
tumble_start = window({0}, {1:text}).start
now = current_timestamp()
proctime = current_timestamp()
""")

# arrays and maps
_add(r"""
array_length = nullif(size({0}), 0)
array_length = CASE WHEN {1} = 1 THEN nullif(size({0}), 0) END
array_lower = CASE WHEN size({0}) > 0 THEN 1 END
array_upper = nullif(size({0}), 0)
array_ndims = CASE WHEN size({0}) > 0 THEN 1 END
cardinality = size({0})
array_cat = concat({0}, {1})
array_prepend = array_prepend({1}, {0})
array_position = nullif(array_position({0}, {1}), 0)
array_positions = transform(filter(transform({0}, (x, i) -> named_struct('x', x, 'i', i + 1)), s -> s.x <=> {1}), s -> s.i)
array_remove = filter({0}, x -> NOT x <=> {1})
array_replace = transform({0}, x -> CASE WHEN x <=> {1} THEN {2} ELSE x END)
array_dims = CASE WHEN size({0}) > 0 THEN concat('[1:', size({0}), ']') END
array_sum = aggregate(slice(filter({0}, x -> x IS NOT NULL), 2, greatest(size({0}), 1)), try_element_at(filter({0}, x -> x IS NOT NULL), 1), (s, x) -> s + x)
array_contains = (size(array_except({1}, {0})) = 0)
array_contained = (size(array_except({0}, {1})) = 0)
array_flatten = flatten({0})
array_reverse = reverse({0})
trim_array = slice({0}, 1, size({0}) - {1})
array_transform = transform({0}, {1})
map_from_key_values = map_from_arrays({0}, {1})
map_access = try_element_at({0}, {1})
map_length = size({0})
map_contains = map_contains_key({0}, {1})
map_cat = map_from_entries(concat(filter(map_entries({0}), e -> NOT map_contains_key({1}, e.key)), map_entries({1})))
map_insert = map_from_entries(concat(filter(map_entries({0}), e -> NOT e.key <=> {1}), array(named_struct('key', {1}, 'value', {2}))))
map_delete = map_filter({0}, (k, v) -> NOT k <=> {1})
""")

# JSON, kept as text
_add(r"""
jsonb_typeof = CASE regexp_extract(schema_of_variant(parse_json({0})), '^(\\w+)', 1) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'STRING' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VOID' THEN 'null' ELSE 'number' END
jsonb_array_length = json_array_length({0})
is_json = (try_parse_json({0}) IS NOT NULL)
jsonb_extract_path_text = get_json_object({0}, concat('$', {rest:path}))
jsonb_extract_path = to_json(try_variant_get(parse_json({0}), concat('$', {rest:path}), 'variant'))
jsonb_object_keys = explode(json_object_keys({0}))
jsonb_exists = coalesce(array_contains(json_object_keys({0}), {1}), false)
jsonb_exists_any = coalesce(arrays_overlap(json_object_keys({0}), {1}), false)
jsonb_exists_all = coalesce(size(array_except({1}, json_object_keys({0}))) = 0, false)
jsonb_object = to_json(map_from_arrays({0}, {1}))
jsonb_concat = to_json(map_from_entries(concat(filter(map_entries(from_json({0}, 'map<string,variant>')), e -> NOT map_contains_key(from_json({1}, 'map<string,variant>'), e.key)), map_entries(from_json({1}, 'map<string,variant>')))))
jsonb_delete = to_json(map_filter(from_json({0}, 'map<string,variant>'), (k, v) -> k <> {1}))
to_jsonb = to_json(to_variant_object({0}))
jsonb_array_elements = explode(transform(from_json({0}, 'array<variant>'), v -> to_json(v)))
jsonb_array_elements_text = explode(transform(from_json({0}, 'array<variant>'), v -> coalesce(try_variant_get(v, '$', 'string'), to_json(v))))
jsonb_to_array = from_json({0}, 'array<variant>')
jsonb_path_exists = (size(jsonb_path_found({0}, {1})) > 0)
jsonb_path_match = (try_element_at(jsonb_path_found({0}, {1}), 1) = 'true')
jsonb_path_query_array = concat('[', array_join(jsonb_path_found({0}, {1}), ','), ']')
jsonb_path_query_first = try_element_at(jsonb_path_found({0}, {1}), 1)
jsonb_contained = jsonb_contains({1}, {0})
encrypt = CASE WHEN contains(lower({2}), 'ecb') THEN aes_encrypt({0}, {1}, 'ECB', 'PKCS') ELSE substring(aes_encrypt({0}, {1}, 'CBC', 'PKCS', unhex(repeat('00', 16))), 17) END
decrypt = CASE WHEN contains(lower({2}), 'ecb') THEN aes_decrypt({0}, {1}, 'ECB', 'PKCS') ELSE aes_decrypt(concat(unhex(repeat('00', 16)), {0}), {1}, 'CBC', 'PKCS') END
jsonb_populate_map = map_from_entries(concat(filter(map_entries({0}), e -> NOT map_contains_key(from_json({1}, 'map<string,string>'), e.key)), map_entries(from_json({1}, 'map<string,string>'))))
""")

# vectors
_add(r"""
l2_distance = sqrt(aggregate(zip_with({0}, {1}, (x, y) -> CAST(x - y AS DOUBLE) * CAST(x - y AS DOUBLE)), 0D, (s, x) -> s + x))
l1_distance = aggregate(zip_with({0}, {1}, (x, y) -> CAST(abs(x - y) AS DOUBLE)), 0D, (s, x) -> s + x)
inner_product = aggregate(zip_with({0}, {1}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE)), 0D, (s, x) -> s + x)
cosine_distance = (1 - aggregate(zip_with({0}, {1}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE)), 0D, (s, x) -> s + x) / (sqrt(aggregate({0}, 0D, (s, x) -> s + CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) * sqrt(aggregate({1}, 0D, (s, x) -> s + CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))))
l2_norm = sqrt(aggregate({0}, 0D, (s, x) -> s + CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))
l2_normalize = transform({0}, x -> CAST(x AS DOUBLE) / sqrt(aggregate({0}, 0D, (s, y) -> s + CAST(y AS DOUBLE) * CAST(y AS DOUBLE))))
subvector = slice({0}, {1}, {2})
vec_concat = concat({0}, {1})
""")

# aggregates
_add(r"""
sum0 = coalesce(sum({0}), 0)
string_agg = listagg({0}, {1})
bool_and = bool_and({0})
jsonb_object_agg = to_json(map_from_entries(collect_list(struct({0}, {1}))))
arg_min = min_by({0}, CASE WHEN {0} IS NOT NULL THEN {1} END)
arg_max = max_by({0}, CASE WHEN {0} IS NOT NULL THEN {1} END)
var_pop = var_pop({0})
stddev_pop = stddev_pop({0})
approx_percentile = percentile_approx({0}, {1})
""")

# table functions
_add(r"""
generate_series = explode(CASE WHEN {0} <= {1} THEN sequence({0}, {1}) ELSE array() END)
generate_series = explode(CASE WHEN {0} = {1} OR ({0} < {1}) = ({2} > {2} - {2}) THEN sequence({0}, {1}, {2}) ELSE array() END)
unnest = explode({0})
generate_subscripts = explode(CASE WHEN size({0}) > 0 THEN sequence(1, size({0})) ELSE array() END)
generate_subscripts = explode(CASE WHEN {1} = 1 AND size({0}) > 0 THEN sequence(1, size({0})) ELSE array() END)
generate_subscripts = explode(CASE WHEN {1} = 1 AND size({0}) > 0 THEN CASE WHEN {2} THEN sequence(size({0}), 1) ELSE sequence(1, size({0})) END ELSE array() END)
range = explode(CASE WHEN {0} < {1} THEN filter(sequence({0}, {1}), x -> x < {1}) ELSE array() END)
range = explode(CASE WHEN {0} <> {1} AND ({0} < {1}) = ({2} > {2} - {2}) THEN filter(sequence({0}, {1}, {2}), x -> x <> {1}) ELSE array() END)
jsonb_each = inline(transform(map_entries(from_json({0}, 'map<string,variant>')), e -> named_struct('key', e.key, 'value', to_json(e.value))))
jsonb_each_text = inline(transform(map_entries(from_json({0}, 'map<string,variant>')), e -> named_struct('key', e.key, 'value', coalesce(try_variant_get(e.value, '$', 'string'), nullif(to_json(e.value), 'null')))))
jsonb_path_query = explode(jsonb_path_found({0}, {1}))
_pg_expandarray = inline(transform({0}, (x, i) -> named_struct('x', x, 'n', i + 1)))
""")

#: PostgreSQL date patterns and Java's, longest first (fixed values)
PATTERNS = [("YYYY", "yyyy"), ("yyyy", "yyyy"), ("HH24", "HH"), ("hh24", "HH"), ("HH12", "hh"), ("hh12", "hh"), ("Month", "MMMM"), ("Mon", "MMM"), ("MM", "MM"), ("mm", "MM"), ("DD", "dd"), ("dd", "dd"), ("MI", "mm"), ("mi", "mm"), ("SS", "ss"), ("ss", "ss"), ("MS", "SSS"), ("US", "SSSSSS"), ("YY", "yy"), ("AM", "a"), ("PM", "a"), ("Day", "EEEE"), ("Dy", "EEE"), ("TZ", "z"), ("HH", "hh")]


def java_pattern(pattern: str) -> str:
    """A PostgreSQL date pattern in Java's letters; other letters are quoted."""
    out, at = "", 0
    while at < len(pattern):
        found = next(((p, j) for p, j in PATTERNS if pattern.startswith(p, at)), None)
        if found:
            out += found[1]
            at += len(found[0])
        else:
            out += f"'{pattern[at]}'" if pattern[at].isalpha() else pattern[at]
            at += 1
    return out


def _literal(text: str) -> str | None:
    """The value of a string literal of translated SQL, else None."""
    if not re.fullmatch(r"(?s)'(?:[^'\\]|\\.|'')*'", text):
        return None
    return re.sub(r"(?s)\\(.)", r"\1", text[1:-1].replace("''", "'"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: marks an expression whose text is JSON already, so that builders take it as it is
JSON = "/*jsonb*/"
#: calls that give JSON text
JSON_CALLS = {"jsonb_build_array", "jsonb_build_object", "jsonb_agg", "jsonb_object_agg", "jsonb_concat", "jsonb_delete", "to_jsonb", "jsonb_extract_path", "jsonb_object", "jsonb_strip_nulls", "jsonb_set", "jsonb_delete_path", "jsonb_path_query_first", "jsonb_path_query_array", "jsonb_array_elements"}


def json_value(value: str) -> str:
    """The JSON text of a value, 'null' of null."""
    if value.lstrip("(").startswith(JSON):
        return f"coalesce({value}, 'null')"
    whole = f"to_json(named_struct('v', {value}), map('ignoreNullFields', 'false'))"
    return f"substring({whole}, 6, char_length({whole}) - 6)"


def groups_of(pattern: str) -> int:
    """The number of capturing groups of a regular expression."""
    plain = re.sub(r"\\.|\[(?:\\.|[^\]])*\]", "", pattern)
    return len(re.findall(r"\((?!\?)|\(\?P?<(?![=!])", plain))


def _flags(args: list[str], at: int) -> str:
    """Letters of a literal flags argument."""
    found = _literal(args[at]) if len(args) > at else ""
    if found is None:
        raise ValueError("flags of a regular expression must be a literal")
    return found


def _pattern(text: str, flags: str) -> str:
    kept = "".join(c for c in flags if c in "imsx")
    return f"concat('(?{kept})', {text})" if kept else text


def regexp_match(args: list[str]) -> str:
    """The groups of the first match, or the match itself if there are none; null without a match."""
    pattern, literal = _pattern(args[1], _flags(args, 2)), _literal(args[1])
    n = groups_of(literal) if literal is not None else 0
    picked = [f"regexp_extract({args[0]}, {pattern}, {k})" for k in range(1, n + 1)] or [f"regexp_substr({args[0]}, {pattern})"]
    return f"CASE WHEN {args[0]} RLIKE {pattern} THEN array({', '.join(picked)}) END"


def regexp_matches(args: list[str]) -> str:
    """Likewise as rows: one for the first match, with flag g one for each."""
    flags = _flags(args, 2)
    pattern, literal = _pattern(args[1], flags), _literal(args[1])
    n = groups_of(literal) if literal is not None else 0
    found = f"regexp_extract_all({args[0]}, {pattern}, 0)"
    if n:
        parts = ", ".join(f"regexp_extract_all({args[0]}, {pattern}, {k})" for k in range(1, n + 1))
        rows = f"transform(arrays_zip({parts}), z -> array({', '.join(f'z.`{k}`' for k in range(n))}))"
    else:
        rows = f"transform({found}, x -> array(x))"
    return f"explode({rows if 'g' in flags else f'slice({rows}, 1, 1)'})"


def regexp_replace(args: list[str]) -> str:
    r"""\1 to \9 and \& stand for groups and the match; without flag g the first match only is replaced, as it takes the rest with it."""
    flags, literal = _flags(args, 3), _literal(args[2])
    shift = 1 if literal is not None and r"\&" in literal and "g" not in flags else 0  # the match is a group of its own
    if literal is None:
        fresh = f"regexp_replace(replace({args[2]}, '$', '\\\\$'), '\\\\\\\\([1-9])', '\\\\$$1')"
    else:
        fresh = _quoted(re.sub(r"\\([1-9&])|[$]|\\\\", lambda m: f"${shift if m[1] == '&' else int(m[1]) + shift}" if m[1] else "\\" + m[0][0], literal))
    pattern = _pattern(args[1], flags)
    if "g" in flags:
        return f"regexp_replace({args[0]}, {pattern}, {fresh})"
    return f"regexp_replace({args[0]}, concat('({'' if shift else '?:'}', {pattern}, ')(?<rest>[\\\\s\\\\S]*)\\\\z'), concat({fresh}, '$', '{{rest}}'))"  # in one literal it would be a variable of Spark's


def format_text(args: list[str]) -> str:
    """format(): %s, %I and %L take the arguments in turn, or n$ by number."""
    text = _literal(args[0])
    if text is None:
        raise ValueError("the text of format() must be a literal")
    parts, at, turn = [], 0, 0
    for m in re.finditer(r"%(?:(\d+)\$)?([sIL%])", text):
        parts.append(_quoted(text[at : m.start()]))
        at = m.end()
        if m[2] == "%":
            parts.append("'%'")
            continue
        turn = int(m[1]) if m[1] else turn + 1
        value = f"CAST({args[turn]} AS STRING)"
        parts.append(f"coalesce({value}, '')" if m[2] == "s" else call("quote_ident" if m[2] == "I" else "quote_nullable", [value]))
    parts.append(_quoted(text[at:]))
    return f"concat({', '.join(parts)})"


def json_list(args: list[str]) -> str:
    if len(args) == 1 and args[0].upper().startswith("VARIADIC "):
        return f"{JSON}to_json({args[0][9:]}, map('ignoreNullFields', 'false'))"
    return f"{JSON}concat('[', concat_ws(',', {', '.join(map(json_value, args))}), ']')" if args else f"{JSON}'[]'"


def json_object(args: list[str]) -> str:
    if len(args) == 1 and args[0].upper().startswith("VARIADIC "):
        a = args[0][9:]
        return f"{JSON}to_json(map_from_entries(transform(sequence(0, size({a}) div 2 - 1), i -> struct(element_at({a}, 2 * i + 1), element_at({a}, 2 * i + 2)))), map('ignoreNullFields', 'false'))"
    if len(args) % 2:
        raise ValueError("jsonb_build_object takes keys and values in turn")
    pairs = [f"concat({json_value(f'CAST({k} AS STRING)')}, ':', {json_value(v)})" for k, v in zip(args[::2], args[1::2])]
    return f"{JSON}concat('{{', concat_ws(',', {', '.join(pairs)}), '}}')" if args else f"{JSON}'{{}}'"


def to_char(args: list[str]) -> str:
    text = _literal(args[1])
    if text is None:
        raise ValueError("a pattern of to_char must be a literal")
    if re.fullmatch(r"[09.,DGSLFMIPR$ ]*[09][09.,DGSLFMIPR$ ]*", text):
        whole, _, rest = text.replace("FM", "").replace("D", ".").partition(".")
        scale = sum(c in "09" for c in rest)
        value, pattern = f"round(CAST({args[0]} AS DECIMAL(38, {scale})), {scale})", _quoted(whole + ("." + rest if rest else ""))
        if re.search("[SPLM]", whole + rest):
            return f"to_char({value}, {pattern})"
        digits = f"trim(to_char(abs({value}), {pattern}))"
        if not rest:  # of a zero one digit is shown
            digits = f"CASE WHEN {value} = 0 THEN coalesce(nullif({digits}, ''), '0') ELSE {digits} END"
        shown = f"concat(CASE WHEN {args[0]} < 0 THEN '-' ELSE '' END, {digits})"
        return shown if "FM" in text else f"lpad({shown}, {len(pattern) - 1}, ' ')"
    return f"date_format({args[0]}, {_quoted(java_pattern(text))})"


def concat(args: list[str]) -> str:
    if len(args) == 1 and args[0].upper().startswith("VARIADIC "):
        return f"array_join({args[0][9:]}, '')"
    return f"concat_ws('', {', '.join(args)})"


#: calls whose expression depends on their literals
BUILDERS = {"regexp_match": regexp_match, "regexp_matches": regexp_matches, "regexp_replace": regexp_replace, "format": format_text, "jsonb_build_array": json_list, "jsonb_build_object": json_object, "to_char": to_char, "concat": concat}


def call(name: str, args: list[str]) -> str | None:
    """The Spark expression of a call, or None if the name means the same in Spark."""
    if name.lower() in BUILDERS:
        return BUILDERS[name.lower()](args)
    args = [re.sub(r"(?i)^VARIADIC ", "", a) for a in args]
    templates = CALLS.get(name.lower())
    if not templates:
        return None
    best = None
    for t in templates:
        used = [int(x) for x in re.findall(r"\{(\d+)", t)]
        need = max(used, default=-1) + 1
        if "{*}" in t or "{rest" in t or need == len(args):
            best = t
            break
    if best is None:
        return None

    def fill(m: re.Match) -> str:
        key, _, how = m[1].partition(":")
        if key == "*":
            return ", ".join(args)
        if key == "rest":
            return ", ".join(f"CASE WHEN {a} RLIKE '^[0-9]+$' THEN concat('[', {a}, ']') ELSE concat('.', {a}) END" for a in args[1:])
        value = args[int(key)]
        if how == "pattern":
            text = _literal(value)
            if text is None:
                raise ValueError("a date pattern must be a literal")
            return "'" + java_pattern(text).replace("'", "\\'") + "'"
        if how == "text":
            m2 = re.fullmatch(r"(?i)INTERVAL\s*('.*')\s*(\w*)", value)
            return value if not m2 else (m2[1] if not m2[2] else f"{m2[1][:-1]} {m2[2].lower()}'")
        return value

    done = re.sub(r"\{([\w*]+(?::\w+)?)\}", fill, best.replace("{{", "\x01").replace("}}", "\x02")).replace("\x01", "{").replace("\x02", "}")
    return JSON + done if name.lower() in JSON_CALLS and not done.startswith("explode") else done
