"""A session that answers PostgreSQL-flavoured statements: queries, DDL, DML, cursors, prepared statements."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import python
from millrace.operators.joins import COMPARISONS, asof_join, inequality_join, ordered_alike
from millrace.operators.time import gap_fill
from millrace.sources.tables import Table
from millrace.sql.dialect import TOKEN, Known, Translator, expression, knowing, query, tokens

_STATEMENTS: list[tuple[re.Pattern, str]] = []


def statement(pattern: str) -> Callable:
    def add(f: Callable) -> Callable:
        _STATEMENTS.append((re.compile(r"(?is)^\s*" + pattern + r"\s*;?\s*$"), f.__name__))
        return f

    return add


ASOF = re.compile(
    r"""(?is)^\s*select\s+(?P<items>.*?)\s+from\s+(?P<left>[\w.]+)(?:\s+(?:as\s+)?(?P<a>(?!asof\b)\w+))?\s+asof\s+(?P<how>left\s+(?:outer\s+)?)?(?:inner\s+)?join\s+
    (?P<right>[\w.]+)(?:\s+(?:as\s+)?(?P<b>(?!on\b)\w+))?\s+on\s+(?P<on>.*?)(?P<rest>\b(?:where|group\s+by|order\s+by|limit)\b.*)?;?\s*$""",
    re.X,
)
THETA = re.compile(
    r"""(?is)^\s*select\s+(?P<items>(?:(?!\bfrom\b).)*?)\s+from\s+(?P<left>\w+)(?:\s+(?:as\s+)?(?P<a>(?!inner\b|join\b)\w+))?\s+(?:inner\s+)?join\s+
    (?P<right>\w+)(?:\s+(?:as\s+)?(?P<b>(?!on\b)\w+))?\s+on\s+(?P<on>.*?)(?P<rest>\b(?:where|group\s+by|having|order\s+by|limit)\b.*)?;?\s*$""",
    re.X,
)
#: words by which a text is no plain join of two tables by comparisons
BEYOND = {"select", "join", "left", "right", "full", "cross", "natural", "lateral", "union", "intersect", "except", "or", "not", "between", "case", "like", "ilike", "in", "is", "exists", "using", "tablesample"}
#: words that end the FROM clause of one table, and those that end its WHERE clause
ENDS = {"where", "group", "having", "order", "limit", "offset", "fetch", "window", ";"}
#: a row's place in a table: its file, the block of the file and its number there; in reverse, letters of the file's name are those that sort the other way
PLACES = {
    "__place": "struct(input_file_name() AS f, input_file_block_start() AS b, monotonically_increasing_id() AS n)",
    "__place_back": "struct(concat(translate(hex(input_file_name()), '0123456789ABCDEF', 'FEDCBA9876543210'), 'G') AS f, -input_file_block_start() AS b, -monotonically_increasing_id() AS n)",
}
NAME = r'(?:if\s+(?:not\s+)?exists\s+)?(?P<name>"?[\w.]+"?)'


@dataclass
class Engine:
    spark: SparkSession
    tables: dict[str, Table] = field(default_factory=dict)
    views: dict[str, str] = field(default_factory=dict)
    materialized: dict[str, str] = field(default_factory=dict)
    objects: dict[str, dict[str, dict]] = field(default_factory=dict)
    cursors: dict[str, list] = field(default_factory=dict)
    prepared: dict[str, str] = field(default_factory=dict)
    variables: dict[str, str] = field(default_factory=dict)
    comments: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        python.install(self.spark)

    def sql(self, text: str) -> DataFrame:
        """The result of one statement; commands give one row that says what was done."""
        with knowing(Known(self._integers(text), relations={"gap_fill": self._gap_fill})):
            return self._sql(text)

    def _sql(self, text: str) -> DataFrame:
        for pattern, name in _STATEMENTS:
            if m := pattern.match(text):
                done = getattr(self, name)(m)
                return done if isinstance(done, DataFrame) else self._said(done or name.upper())
        if m := re.match(r"(?is)^(?P<body>.*)\bemit\s+on\s+window\s+close\s*;?\s*$", text):
            return self._closed(m["body"])
        text = self._changelogs(text)
        if m := ASOF.match(text):
            return self._asof(m)
        if (m := THETA.match(text)) and (joined := self._theta(m)) is not None:
            return joined
        if re.search(r"(?i)\barg_(min|max)\s*\(", text) and (placed := self._placed(text)):
            with knowing(Known(self._integers(text), relations={"gap_fill": self._gap_fill}, places=tuple(PLACES))):
                return self.spark.sql(query(placed))
        return self.spark.sql(query(text))

    def _integers(self, text: str) -> set[str]:
        """Names of the integer columns of the relations that a statement names, where no other of them has the name."""
        own, others = set(), set()
        # types matter to divisions only
        for name in set(re.findall(r"[A-Za-z_]\w*", text)) if "/" in text else ():
            if self.spark.catalog.tableExists(name):
                for f in self.spark.table(name).schema.fields:
                    (own if isinstance(f.dataType, T.IntegralType) else others).add(f.name.lower())
        return own - others

    def _view(self, frame: DataFrame) -> str:
        name = f"millrace_{uuid.uuid4().hex}"
        frame.createOrReplaceTempView(name)
        return name

    def _gap_fill(self, args: list[str]) -> str:
        """GAP_FILL(table, time column, interval, LOCF(c), INTERPOLATE(c), KEEPNULL(c), PARTITION BY is by the fills' absence)."""
        source, time, step, *rest = args
        fills = {}
        for how in rest:
            m = re.fullmatch(r"(?i)(locf|interpolate|keepnull)\(`?(\w+)`?\)", how.strip())
            if not m:
                raise ValueError(f"unknown fill {how}")
            fills[m[2]] = m[1].lower()
        frame = self.spark.table(source.strip("`")) if not source.startswith("(") else self.spark.sql(source[1:-1])
        return self._view(gap_fill(frame, time.strip("`"), re.sub(r"(?i)^INTERVAL\s*'(.*?)'\s*(\w*)$", r"\1 \2", step).strip(), fills))

    def _changelogs(self, text: str) -> str:
        """WITH x AS changelog FROM t: x has the table's changes, with changelog_op and _changelog_row_id."""

        def named(m: re.Match) -> str:
            changes = self.tables[m["table"].rpartition(".")[2]].changes()
            ids = F.monotonically_increasing_id() + F.col("version").cast("long") * F.lit(1 << 40)
            view = self._view(changes.withColumns({"_changelog_row_id": ids, "changelog_op": F.col("op")}).drop("op", "version"))
            return f"{m['name']} AS (SELECT * FROM {view})"

        return re.sub(r"(?i)\b(?P<name>\w+)\s+as\s+changelog\s+from\s+(?P<table>[\w.]+)", named, text)

    def _closed(self, body: str) -> DataFrame:
        """EMIT ON WINDOW CLOSE: what the watermark of the source table has passed."""
        marked = [t for t in self.tables.values() if t.watermark and re.search(rf"(?i)\b{t.name}\b", body)]
        if len(marked) != 1:
            raise ValueError("EMIT ON WINDOW CLOSE needs one source table with a watermark")
        column, late = marked[0].watermark
        column = column.strip("`")
        passed = f"(SELECT max({late}) FROM {marked[0].name})"
        if re.search(r"(?i)\bgap_fill\s*\(", body):
            view = self._view(self.spark.sql(f"SELECT * FROM {marked[0].name} WHERE `{column}` <= {passed}"))
            return self._sql(re.sub(rf"(?i)\b{marked[0].name}\b", view, body))
        out = self._sql(body)
        if "window_end" in out.columns:
            return self.spark.sql(f"SELECT * FROM {self._view(out)} WHERE window_end <= {passed}")
        size = re.search(rf"(?is)\b(tumble|hop)\s*\(.*?(interval\s+'[^']*'(?:\s+\w+)?)\s*\)", body)
        if "window_start" in out.columns and size:
            return self.spark.sql(f"SELECT * FROM {self._view(out)} WHERE window_start + {expression(size[2])} <= {passed}")
        if column in out.columns:  # rows in order of time, as far as it is settled
            return self.spark.sql(f"SELECT * FROM {self._view(out)} WHERE `{column}` <= {passed}")
        raise NotImplementedError("EMIT ON WINDOW CLOSE needs window_end, window_start or the watermark column in the result")

    def _asof(self, m: re.Match) -> DataFrame:
        """ASOF [LEFT] JOIN, planned by the operator; afterwards each side is a struct under its alias."""
        sides = []
        for text, alias in ((m["left"], m["a"]), (m["right"], m["b"])):
            frame = self._sql(f"SELECT * FROM {text}")
            sides.append((alias or text, frame))
        (a, left), (b, right) = sides
        pairs, inequality = [], None
        for part in re.split(r"(?i)\s+and\s+", m["on"].strip()):
            side = re.fullmatch(r"\(?\s*(?:(\w+)\.)?(\w+)\s*(=|<=|>=|<|>)\s*(?:(\w+)\.)?(\w+)\s*\)?", part.strip())
            if not side:
                raise ValueError(f"an as-of condition compares two columns: {part}")
            p, x, sign, q, y = side.groups()
            if p == b or q == a or (p is None and x not in left.columns):
                x, y, sign = y, x, {"<": ">", ">": "<", "<=": ">=", ">=": "<="}.get(sign, sign)
            if sign == "=":
                pairs.append((x, y))
            elif inequality:
                raise ValueError("an as-of join has exactly one inequality")
            else:
                inequality = x, sign, y
        if not inequality or not pairs:
            raise ValueError("an as-of join has at least one equality and exactly one inequality")
        keys = [f"key_{k}" for k in range(len(pairs))]
        own = left.select(*[F.col(x).alias(k) for k, (x, _) in zip(keys, pairs)], F.col(inequality[0]).alias("at_a"), F.struct(*left.columns).alias(a))
        other = right.select(*[F.col(y).alias(k) for k, (_, y) in zip(keys, pairs)], F.col(inequality[2]).alias("at_b"), F.struct(*right.columns).alias(b))
        joined = asof_join(own, other, keys, ("at_a", inequality[1], "at_b"), "left" if m["how"] else "inner", ["at_b"])
        common = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
        flat = [F.col(f"`{side}`.`{c}`").alias(c) for side, frame in sides for c in frame.columns if c.lower() not in common]
        view = self._view(joined.select(a, b, *flat))
        items = re.sub(r"^\s*\*\s*$", f"{a}.*, {b}.*", m["items"])
        return self._sql(f"SELECT {items} FROM {view} {m['rest']}")

    def _theta(self, m: re.Match) -> DataFrame | None:
        """A join of two tables by inequalities alone, planned by the operator instead of as a nested loop; None if the text is anything else."""
        a, b = m["a"] or m["left"], m["b"] or m["right"]
        if '"' in m[0] or a.lower() == b.lower() or not all(self.spark.catalog.tableExists(m[side]) for side in ("left", "right")):
            return None
        found = [(kind, value.lower() if kind == "name" else value) for kind, value in tokens(m["on"])]
        outside = [value.lower() for kind, value in tokens(f"{m['items']} {m['rest'] or ''}") if kind == "name"]
        if BEYOND & {v for kind, v in found if kind == "name"} or {"select", "join", "union", "intersect", "except"} & set(outside):
            return None
        frames = {a.lower(): self.spark.table(m["left"]).alias(a), b.lower(): self.spark.table(m["right"]).alias(b)}
        if any(f.isStreaming for f in frames.values()):
            return None
        columns = {side: {c.lower() for c in f.columns} for side, f in frames.items()}
        parts: list[list[tuple[str, str]]] = [[]]
        for token in found:
            if token == ("name", "and"):
                parts.append([])
            else:
                parts[-1].append(token)
        conditions = []
        for part in parts:
            signs = [k for k, (kind, v) in enumerate(part) if kind == "op" and v in COMPARISONS]
            if len(signs) != 1 or any(kind not in ("name", "number", "op", "punct") or (kind == "op" and v in ("=", "<>", "!=")) or v in ("(", ")") for kind, v in part):
                return None
            ends = []
            for piece in (part[: signs[0]], part[signs[0] + 1 :]):
                sides = set()
                for k, (kind, v) in enumerate(piece):
                    if kind != "name" or (k + 1 < len(piece) and piece[k + 1][1] == "."):
                        continue
                    of = {piece[k - 2][1]} if k > 1 and piece[k - 1][1] == "." else {side for side in columns if v in columns[side]}
                    if len(of) != 1 or not of <= set(columns) or v not in columns[min(of)]:
                        return None
                    sides |= of
                if len(sides) != 1:
                    return None
                ends.append((sides.pop(), F.expr(expression(" ".join(v for _, v in piece).replace(" . ", ".")))))
            sign = part[signs[0]][1]
            if ends[0][0] == ends[1][0]:
                return None
            if ends[0][0] == b.lower():
                ends, sign = ends[::-1], {"<": ">", ">": "<", "<=": ">=", ">=": "<="}[sign]
            conditions.append((ends[0][1], sign, ends[1][1]))
        left, right = frames[a.lower()], frames[b.lower()]
        if not all(ordered_alike(left.select(x).schema[0].dataType, right.select(y).schema[0].dataType) for x, _, y in conditions):
            return None
        # only what the text names is carried along; a side is a struct under its alias, as for as-of joins
        whole = re.search(r"(?:^|[,.])\s*\*", m["items"])
        common = columns[a.lower()] & columns[b.lower()]
        picked = []
        for n, (side, frame) in enumerate(((a, left), (b, right))):
            named = [c for c in frame.columns if whole or c.lower() in outside]
            flat = [F.col(f"`{side}`.`{c}`").alias(f"__{n}_{c}") for c in named]
            keys = [c[2 * n].alias(f"__{n}_key{k}") for k, c in enumerate(conditions)]
            picked.append((side, named, frame.select(*flat, *keys)))
        joined = inequality_join(picked[0][2], picked[1][2], [(F.col(f"__0_key{k}"), sign, F.col(f"__1_key{k}")) for k, (_, sign, _) in enumerate(conditions)])
        structs = [F.struct(*[F.col(f"`__{n}_{c}`").alias(c) for c in named] or [F.lit(None).alias("__none")]).alias(side) for n, (side, named, _) in enumerate(picked)]
        alone = [F.col(f"`__{n}_{c}`").alias(c) for n, (side, named, _) in enumerate(picked) for c in named if c.lower() not in common | {a.lower(), b.lower()}]
        view = self._view(joined.select(*structs, *alone))
        items = re.sub(r"^\s*\*\s*$", f"{a}.*, {b}.*", m["items"])
        return self.spark.sql(query(f"SELECT {items} FROM {view} {m['rest'] or ''}"))

    def _placed(self, text: str) -> str | None:
        """A query of one table, reading a view of it that holds each row's place, so that the first of tied rows can be told; None if the text is anything else."""
        found = [m for m in TOKEN.finditer(text) if m.lastgroup != "space"]
        words = [m[0].lower() for m in found] + [";"] * 3
        deep, depth = [], 0
        for w in words:
            depth -= w in (")", "]")
            deep.append(depth)
            depth += w in ("(", "[")
        froms = [k for k, w in enumerate(words) if w == "from" and deep[k] == 0]
        if words[0] != "select" or len(froms) != 1 or {"join", "union", "intersect", "except"} & set(words) or words.count("select") > 1 or any(m.lastgroup == "quoted" for m in found):
            return None
        if any(w == "*" and words[k - 1] in ("select", "distinct", ",", ".") for k, w in enumerate(words)):
            return None
        at = froms[0] + 1
        table = alias = words[at]
        k = at + 1
        if words[k] not in ENDS:
            k += words[k] == "as"
            alias, k = words[k], k + 1
        if words[k] not in ENDS or not re.fullmatch(r"\w+", alias) or not re.fullmatch(r"\w+", table) or not self.spark.catalog.tableExists(table):
            return None
        frame = self.spark.table(table).alias(alias)
        if frame.isStreaming or set(PLACES) & {c.lower() for c in frame.columns}:
            return None
        end = k
        if words[k] == "where":  # stays below the places, from where it can reach the files
            end = next(n for n in range(k + 1, len(words)) if words[n] in ENDS and deep[n] == 0)
            frame = frame.where(expression(text[found[k].end() : found[end - 1].end()]))
        try:
            view = self._view(frame.selectExpr("*", *[f"{place} AS {name}" for name, place in PLACES.items()]))
        except AnalysisException:  # a view of several tables: its rows have no place
            return None
        return f"{text[: found[froms[0]].start()]} FROM {view} AS {alias} {text[found[end].start() :] if end < len(found) else ''}"

    def script(self, text: str) -> list[DataFrame]:
        parts, held, quote = [], "", None
        for c in text:
            if quote:
                quote = None if c == quote else quote
            elif c in "'\"":
                quote = c
            elif c == ";":
                parts.append(held)
                held = ""
                continue
            held += c
        return [self.sql(p) for p in [*parts, held] if p.strip()]

    def _said(self, what: str) -> DataFrame:
        return self.spark.createDataFrame([(what,)], "result string")

    def _show(self, name: str) -> None:
        """The table's new version, and the views over it planned anew: they are answered from what the tables hold."""
        self.tables[name].read().createOrReplaceTempView(name)
        touched = {name}
        for view, body in {**self.views, **self.materialized}.items():
            if touched & set(re.findall(r"\w+", body)):
                self.sql(body).createOrReplaceTempView(view)
                touched.add(view)

    # tables

    @statement(r"create\s+table\s+" + NAME + r"\s*(?P<how>with\s*\(.*?\))?\s+as\s+(?P<body>(?:select|with|values).*)")
    def create_table_as(self, m: re.Match) -> str:
        rows = self.sql(m["body"])
        self.tables[m["name"]] = Table(self.spark, m["name"], rows.schema)
        self.tables[m["name"]].insert(rows)
        self._show(m["name"])
        return "CREATE TABLE"

    @statement(r"create\s+table\s+" + NAME + r"\s*\((?P<columns>.*)\)\s*(?P<tail>(?:append\s+only)?\s*(?:on\s+conflict\s+.*?)?\s*(?:with\s+version\s+column\s*\(?\w+\)?)?\s*(?:with\s*\(.*\))?)")
    def create_table(self, m: re.Match) -> str:
        fields, key, defaults, generated, watermark = [], [], {}, {}, None
        inner = Translator("(" + m["columns"] + ")")
        inner.take()
        parts: list[list[tuple[str, str]]] = [[]]
        depth = 0
        for t in inner.inside(")").tokens:
            depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(t[1], 0)
            if t[1] == "," and depth == 0:
                parts.append([])
            else:
                parts[-1].append(t)
        for part in parts:
            t = Translator("")
            t.tokens = part
            first = t.word()
            if first == "primary":
                key = [x[1].strip("`") for x in part[2:] if x[0] in ("name", "quoted")]
            elif first == "watermark":
                column = part[2][1]
                rest = Translator("")
                rest.tokens = part[4:]
                watermark = column, rest.everything()
            else:
                name = t.take().strip("`")
                kind = t.type_name()
                while t.at < len(t.tokens):
                    word = t.take().lower()
                    if word == "primary":
                        t.take()
                        key = [name]
                    elif word == "default":
                        defaults[name] = t.primary()
                    elif word == "as":
                        rest = Translator("")
                        rest.tokens = t.tokens[t.at :]
                        generated[name] = rest.everything()
                        break
                fields.append(f"`{name}` {kind}")
        schema = self.spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {f.split(' ', 1)[1]}) AS {f.split(' ', 1)[0]}" for f in fields)).schema
        tail = (m["tail"] or "").lower()
        policy = "ignore" if "do nothing" in tail else "if_not_null" if "if not null" in tail else "overwrite"
        version = re.search(r"version\s+column\s*\(?(\w+)", tail)
        self.tables[m["name"]] = Table(self.spark, m["name"], T.StructType([T.StructField(f.name, f.dataType) for f in schema]), key, "append only" in tail, policy, version[1] if version else None, defaults, generated, watermark, keep_changes=True)
        self._show(m["name"])
        return "CREATE TABLE"

    @statement(r"insert\s+into\s+(?P<name>[\w.]+)\s*(?:\((?P<columns>[^)]*)\))?\s*(?P<body>(?:values|select|with).*?)(?:\s+returning\s+(?P<out>.*))?")
    def insert(self, m: re.Match) -> DataFrame | str:
        table = self.tables[m["name"]]
        rows = self.sql(m["body"])
        names = [c.strip() for c in m["columns"].split(",")] if m["columns"] else [f.name for f in table.schema.fields if f.name not in table.generated][: len(rows.columns)]
        done = table.insert(rows.toDF(*names))
        self._show(m["name"])
        return self._returning(done, m["out"], "INSERT")

    @statement(r"delete\s+from\s+(?P<name>[\w.]+)(?:\s+where\s+(?P<where>.*?))?(?:\s+returning\s+(?P<out>.*))?")
    def delete(self, m: re.Match) -> DataFrame | str:
        done = self.tables[m["name"]].delete(expression(m["where"]) if m["where"] else "true")
        self._show(m["name"])
        return self._returning(done, m["out"], "DELETE")

    @statement(r"update\s+(?P<name>[\w.]+)\s+set\s+(?P<set>.*?)(?:\s+where\s+(?P<where>.*?))?(?:\s+returning\s+(?P<out>.*))?")
    def update(self, m: re.Match) -> DataFrame | str:
        parts = Translator(m["set"] + ",")
        values: dict[str, str] = {}
        held: list[tuple[str, str]] = []
        depth = 0
        for t in parts.tokens:
            depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(t[1], 0)
            if t[1] == "," and depth == 0:
                rest = Translator("")
                rest.tokens = held[2:]
                values[held[0][1]] = rest.everything()
                held = []
            else:
                held.append(t)
        done = self.tables[m["name"]].update(values, expression(m["where"]) if m["where"] else "true")
        self._show(m["name"])
        return self._returning(done, m["out"], "UPDATE")

    def _returning(self, rows: DataFrame, out: str | None, what: str) -> DataFrame | str:
        if not out:
            return what
        return rows if out.strip() == "*" else rows.selectExpr(*[expression(x) for x in re.split(r",(?![^(]*\))", out)])

    # views

    @statement(r"create\s+(?:or\s+replace\s+)?view\s+" + NAME + r"\s+as\s+(?P<body>.*)")
    def create_view(self, m: re.Match) -> str:
        self.views[m["name"]] = m["body"]
        self.sql(m["body"]).createOrReplaceTempView(m["name"])
        return "CREATE VIEW"

    @statement(r"create\s+materialized\s+view\s+" + NAME + r"\s+as\s+(?P<body>.*)")
    def create_materialized_view(self, m: re.Match) -> str:
        """A materialized view always answers from the current tables; it is planned anew when one of them changes. On streams see ``streaming.views``."""
        self.materialized[m["name"]] = m["body"]
        self.sql(m["body"]).createOrReplaceTempView(m["name"])
        return "CREATE MATERIALIZED VIEW"

    @statement(r"refresh\s+(?:materialized\s+view\s+|table\s+)?(?P<name>\w+)")
    def refresh(self, m: re.Match) -> str:
        body = self.materialized.get(m["name"]) or self.views.get(m["name"])
        if body:
            self.sql(body).createOrReplaceTempView(m["name"])
        elif m["name"] in self.tables:
            self._show(m["name"])
        return "REFRESH"

    @statement(r"create\s+(?P<kind>source|sink|connection|secret|index|subscription|schema|database|user)\s+" + NAME + r"(?P<rest>.*)")
    def create_object(self, m: re.Match) -> str:
        options = dict(re.findall(r"([\w.]+)\s*=\s*'([^']*)'", m["rest"]))
        self.objects.setdefault(m["kind"].lower(), {})[m["name"]] = {"definition": m[0].strip(), "options": options}
        if m["kind"].lower() == "source" and options.get("connector"):
            from millrace.sources.connectors import read

            columns = re.match(r"(?s)\s*\((.*?)\)\s*with", m["rest"], re.I)
            read(self.spark, options, columns[1] if columns else None).createOrReplaceTempView(m["name"])
        if m["kind"].lower() == "sink" and options.get("connector"):
            from millrace.sources.connectors import write

            body = re.search(r"(?is)\bas\s+(select.*?)\s*with\s*\(", m["rest"])
            origin = re.search(r"(?i)\bfrom\s+(\w+)", m["rest"])
            write(self.sql(body[1]) if body else self.spark.table(origin[1]), options)
        if m["kind"].lower() == "sink" and (into := re.match(r"(?is)\s+into\s+(\w+)\s+as\s+(.*)", m["rest"])):
            self.tables[into[1]].insert(self.sql(into[2]))
            self._show(into[1])
        return f"CREATE {m['kind'].upper()}"

    @statement(r"create\s+function\s+(?P<name>\w+)\s*\((?P<args>.*?)\)\s*returns\s+(?P<kind>[\w ()]+?)\s+language\s+sql\s+as\s+(?:\$\$\s*select\s+(?P<a>.*?)\$\$|'\s*select\s+(?P<b>.*?)')")
    def create_function(self, m: re.Match) -> str:
        args = []
        for k, a in enumerate(x for x in m["args"].split(",") if x.strip()):
            words = a.split()
            name = words[0] if len(words) > 1 else f"_{k + 1}"
            args.append(f"{name} {Translator(' '.join(words[1:]) or words[0]).type_name()}")
        body = re.sub(r"\$(\d+)", r"_\1", (m["a"] or m["b"]).strip().rstrip(";"))
        self.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {m['name']}({', '.join(args)}) RETURNS {Translator(m['kind']).type_name()} RETURN {expression(body)}")
        return "CREATE FUNCTION"

    @statement(r"drop\s+(?P<kind>materialized\s+view|view|table|source|sink|connection|secret|index|subscription|schema|database|user|function|aggregate)\s+" + NAME + r".*")
    def drop(self, m: re.Match) -> str:
        kind = " ".join(m["kind"].lower().split())
        {"table": self.tables, "view": self.views, "materialized view": self.materialized}.get(kind, self.objects.get(kind, {})).pop(m["name"], None)
        if kind == "function":
            self.spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {m['name']}")
        elif kind in ("table", "view", "materialized view", "source"):
            self.spark.catalog.dropTempView(m["name"])
        return f"DROP {kind.upper()}"

    @statement(r"alter\s+(?P<kind>table|view|materialized\s+view|source|sink)\s+(?P<name>\w+)\s+rename\s+to\s+(?P<new>\w+)")
    def alter_rename(self, m: re.Match) -> str:
        for held in (self.tables, self.views, self.materialized, *self.objects.values()):
            if m["name"] in held:
                held[m["new"]] = held.pop(m["name"])
        self.spark.table(m["name"]).createOrReplaceTempView(m["new"])
        self.spark.catalog.dropTempView(m["name"])
        return "ALTER"

    @statement(r"alter\s+table\s+(?P<name>\w+)\s+(?P<what>add|drop)\s+column\s+(?P<column>\w+)\s*(?P<kind>[\w ()]*)")
    def alter_column(self, m: re.Match) -> str:
        table, old = self.tables[m["name"]], self.tables[m["name"]].read()
        if m["what"].lower() == "add":
            new = old.withColumn(m["column"], F.lit(None).cast(Translator(m["kind"]).type_name()))
        else:
            new = old.drop(m["column"])
        self.tables[m["name"]] = Table(self.spark, m["name"], new.schema, table.key, table.append_only, table.on_conflict, table.version_column, table.defaults, table.generated, table.watermark, table.keep_changes)
        self.tables[m["name"]]._write(new, [])
        self._show(m["name"])
        return "ALTER TABLE"

    # the session

    @statement(r"show\s+(?P<what>tables|views|materialized\s+views|sources|sinks|indexes|connections|secrets|subscriptions|schemas|databases|users|functions)")
    def show(self, m: re.Match) -> DataFrame:
        what = " ".join(m["what"].lower().split())
        names = {"tables": self.tables, "views": self.views, "materialized views": self.materialized}.get(what)
        if names is None:
            names = self.objects.get({"indexes": "index"}.get(what, what[:-1]), {})
        return self.spark.createDataFrame([(n,) for n in sorted(names)], "name string")

    @statement(r"show\s+create\s+(?P<kind>table|view|materialized\s+view|source|sink)\s+(?P<name>\w+)")
    def show_create(self, m: re.Match) -> DataFrame:
        name = m["name"]
        text = self.views.get(name) or self.materialized.get(name) or next((o[name]["definition"] for o in self.objects.values() if name in o), None)
        if text is None:
            text = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.tables[name].schema.fields)
        return self.spark.createDataFrame([(name, text)], "name string, definition string")

    @statement(r"(?:describe|show\s+columns\s+from)\s+(?P<name>\w+)")
    def describe(self, m: re.Match) -> DataFrame:
        key = self.tables[m["name"]].key if m["name"] in self.tables else []
        rows = [(f.name, f.dataType.simpleString(), f.name in key, self.comments.get(f"{m['name']}.{f.name}")) for f in self.spark.table(m["name"]).schema.fields]
        return self.spark.createDataFrame(rows, "name string, type string, is_key boolean, description string")

    @statement(r"comment\s+on\s+(?:table|column|view)\s+(?P<name>[\w.]+)\s+is\s+'(?P<text>[^']*)'")
    def comment(self, m: re.Match) -> str:
        self.comments[m["name"]] = m["text"]
        return "COMMENT"

    @statement(r"explain\s*(?:\((?P<how>[^)]*)\))?\s*(?P<body>(?:select|with|values).*)")
    def explain(self, m: re.Match) -> DataFrame:
        return self.spark.sql("EXPLAIN FORMATTED " + query(m["body"]))

    @statement(r"set\s+(?:session\s+)?(?P<name>[\w.]+)\s*(?:=|to)\s*(?P<value>.+)")
    def set_variable(self, m: re.Match) -> str:
        self.variables[m["name"].lower()] = m["value"].strip().strip("'")
        if m["name"].lower() in ("timezone", "time_zone"):
            self.spark.conf.set("spark.sql.session.timeZone", self.variables[m["name"].lower()])
        return "SET"

    @statement(r"show\s+(?P<name>[\w.]+)")
    def show_variable(self, m: re.Match) -> DataFrame:
        return self.spark.createDataFrame([(self.variables.get(m["name"].lower()),)], "value string")

    @statement(r"declare\s+(?P<name>\w+)\s+(?:subscription\s+)?cursor\s+for\s+(?P<body>.*)")
    def declare_cursor(self, m: re.Match) -> str:
        frame = self.sql(m["body"])
        self.cursors[m["name"]] = [frame.schema, frame.toLocalIterator()]
        return "DECLARE CURSOR"

    @statement(r"fetch\s+(?P<n>next|\d+)\s+from\s+(?P<name>\w+).*")
    def fetch_cursor(self, m: re.Match) -> DataFrame:
        schema, rows = self.cursors[m["name"]]
        n = 1 if m["n"].lower() == "next" else int(m["n"])
        return self.spark.createDataFrame([r for _, r in zip(range(n), rows)], schema)

    @statement(r"close\s+(?P<name>\w+)")
    def close_cursor(self, m: re.Match) -> str:
        if m["name"].lower() == "all":
            self.cursors.clear()
        else:
            self.cursors.pop(m["name"])
        return "CLOSE CURSOR"

    @statement(r"prepare\s+(?P<name>\w+)\s*(?:\([^)]*\))?\s+as\s+(?P<body>.*)")
    def prepare(self, m: re.Match) -> str:
        self.prepared[m["name"]] = m["body"]
        return "PREPARE"

    @statement(r"execute\s+(?P<name>\w+)\s*(?:\((?P<args>.*)\))?")
    def execute(self, m: re.Match) -> DataFrame:
        args = [a.strip() for a in re.split(r",(?=(?:[^']*'[^']*')*[^']*$)", m["args"] or "")]
        return self.sql(re.sub(r"\$(\d+)", lambda x: args[int(x[1]) - 1], self.prepared[m["name"]]))

    @statement(r"deallocate\s+(?:prepare\s+)?(?P<name>\w+)")
    def deallocate(self, m: re.Match) -> str:
        self.prepared.clear() if m["name"].lower() == "all" else self.prepared.pop(m["name"])
        return "DEALLOCATE"

    @statement(r"vacuum(?:\s+full)?(?:\s+(?P<name>\w+))?")
    def vacuum(self, m: re.Match) -> str:
        for name, table in self.tables.items():
            if m["name"] in (None, name):
                table.vacuum()
        return "VACUUM"

    @statement(r"(?P<what>rollback|abort)(?:\s+(?:work|transaction))?")
    def rollback(self, m: re.Match) -> None:
        raise NotImplementedError("statements take effect one by one: there is nothing to roll back to")

    @statement(r"(?P<what>flush|wait|begin|start\s+transaction|commit|discard\s+all|recover)")
    def nothing(self, m: re.Match) -> str:
        """Every statement is complete when it returns, so there is nothing to wait for."""
        return " ".join(m["what"].upper().split())
