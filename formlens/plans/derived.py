"""Inputs derived from the driver tables, expressed for Spark and for DuckDB.

The test tables hold no survey, so a form export is derived from them:

* ``survey_form``: one row per order, with the raw form headers.  Values come
  from ``orders``/``customer``/``nation``/``region`` columns and include the
  dirt the cleaning rules exist for (blank cells, padded text, impossible
  and future dates, non-numeric semesters, identifier columns).  ``file_id``
  groups rows into yearly exports: the order year, plus one for every
  fourth order (late submissions), so each export has a real most-frequent
  year.
* ``file_headers``: one export per customer with its header list
  ``(file_id, pos, header)``, built from header templates (raw, cleaned,
  cleaned with older aliases, unknown) and per-customer variants (upper
  case, accents removed, a mandatory header missing, two headers swapped,
  an empty ``Unnamed: 60`` header).

The same expressions are emitted as DuckDB SQL for the oracle; where the
dialects differ (date formatting, date arithmetic, casts) each side has its
own text.  Work grows with ``orders`` and ``customer``.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlens import config as C

# (raw header, SQL expression shared by Spark and DuckDB, DuckDB override)
_DMY = ("date_format({x}, 'dd/MM/yyyy')", "strftime({x}, '%d/%m/%Y')")
_DMY_HMS = ("date_format({x}, 'dd/MM/yyyy HH:mm:ss')", "strftime({x}, '%d/%m/%Y %H:%M:%S')")
_BIRTH_DAY = (
    "date_sub(CAST(o_orderdate AS DATE), CAST(5000 + o_orderkey % 9000 AS INT))",
    "CAST(o_orderdate AS DATE) - CAST(5000 + o_orderkey % 9000 AS INTEGER)",
)


def _both(spark_sql: str, duck_sql: str | None = None) -> tuple[str, str]:
    return spark_sql, duck_sql if duck_sql is not None else spark_sql


FORM_COLUMNS: list[tuple[str, tuple[str, str]]] = [
    ("file_id", _both("CAST(year(o_orderdate) + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS BIGINT)")),
    ("respondent_id", _both("o_orderkey")),
    ("Marca temporal", (_DMY_HMS[0].format(x="o_orderdate"), _DMY_HMS[1].format(x="o_orderdate"))),
    ("Dirección de correo electrónico", _both("concat(lower(replace(c_name, '#', '.')), '@correo.example')")),
    (
        "Fecha de diligenciamiento",
        (
            "CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 'sin fecha' ELSE "
            + _DMY[0].format(x="o_orderdate") + " END",
            "CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 'sin fecha' ELSE "
            + _DMY[1].format(x="o_orderdate") + " END",
        ),
    ),
    ("Nombres y apellidos (como aparecen en el documento de identificación)", _both("c_name")),
    (
        "Número de documento de identidad (Solo el número sin puntos, comas o espacios)",
        _both("CAST(1000000 + o_custkey * 37 AS STRING)"),
    ),
    (
        "Fecha de nacimiento",
        (
            "CASE WHEN o_orderkey % 41 = 0 THEN '31/02/2001' WHEN o_orderkey % 97 = 0 THEN '05/06/2031' ELSE "
            + _DMY[0].format(x=_BIRTH_DAY[0]) + " END",
            "CASE WHEN o_orderkey % 41 = 0 THEN '31/02/2001' WHEN o_orderkey % 97 = 0 THEN '05/06/2031' ELSE "
            + _DMY[1].format(x="(" + _BIRTH_DAY[1] + ")") + " END",
        ),
    ),
    ("Estrato socioeconómico", _both("CASE WHEN o_orderkey % 37 = 0 THEN '  ' ELSE CAST(1 + o_orderkey % 6 AS STRING) END")),
    ("Ciudad, municipio o corregimiento de nacimiento", _both("n_name")),
    ("Departamento de nacimiento", _both("r_name")),
    ("País de nacimiento", _both("CASE WHEN n_regionkey = 1 THEN 'Colombia' ELSE concat('País ', CAST(n_regionkey AS STRING)) END")),
    ("Ciudad, municipio o corregimiento de residencia", _both("CASE o_orderkey % 3 WHEN 0 THEN n_name ELSE 'Cali' END")),
    ("Zona de residencia", _both("CASE o_orderstatus WHEN 'F' THEN 'Urbana' WHEN 'O' THEN 'Rural' ELSE ' Urbana  ' END")),
    ("Dirección de residencia", _both("concat('Calle ', CAST(o_custkey % 100 AS STRING), ' # ', CAST(o_orderkey % 50 AS STRING))")),
    ("Barrio de residencia", _both("concat('Barrio ', CAST(c_nationkey AS STRING))")),
    ("Teléfono fijo o celular", _both("CAST(3000000000 + o_custkey AS STRING)")),
    ("Estado civil", _both("CASE o_orderkey % 4 WHEN 0 THEN 'Soltero/a/e' WHEN 1 THEN 'Casado/a/e' WHEN 2 THEN 'Unión  libre' ELSE NULL END")),
    (
        "Auto-reconocimiento étnico (Hace referencia al sentido de pertenencia que expresa una persona frente a un colectivo, de acuerdo con su identidad y formas de interactuar en y con el mundo) ",
        _both("CASE c_custkey % 5 WHEN 0 THEN 'Ninguno' WHEN 1 THEN 'Afrodescendiente' WHEN 2 THEN 'Indígena' WHEN 3 THEN 'Mestizo/a/e' ELSE '' END"),
    ),
    ("¿A qué grupo poblacional perteneces?", _both("lower(c_mktsegment)")),
    (
        "¿Cuál es tu identidad de géneros? ( es decir, ¿Cómo te vives, sientes, percibes, etc.?)",
        _both(
            "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN '   ' "
            "WHEN o_orderkey % 7 = 0 THEN concat('  ', replace(o_orderpriority, '-', '  '), ' ') "
            "ELSE replace(o_orderpriority, '-', ' ') END"
        ),
    ),
    (
        "Expresión de género (¿Cuál es tu apariencia?/¿cómo te muestras al mundo?)",
        _both("CASE o_orderkey % 3 WHEN 0 THEN 'Femenina' WHEN 1 THEN 'Masculina' ELSE 'Andrógina' END"),
    ),
    (
        "¿Cuál es tu orientación sexual?  es decir,  ¿Quién/es te gusta(n) o  atrae(n)?",
        _both(
            "CASE (o_custkey + o_orderkey) % 5 WHEN 0 THEN 'Heterosexual' WHEN 1 THEN 'Bisexual' "
            "WHEN 2 THEN 'Gay' WHEN 3 THEN 'Lesbiana' ELSE '  Pansexual' END"
        ),
    ),
    (
        "¿Has realizado cambio de nombre y/o del componente sexo en tu documento de identidad?",
        _both("CASE o_orderkey % 5 WHEN 0 THEN 'Sí' ELSE 'No' END"),
    ),
    (
        'Si la respuesta a la pregunta anterior fue "NO" o sólo cambiaste uno de los dos componentes, ¿Qué te impidió realizar el cambio?',
        _both("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Trámites' END"),
    ),
    (
        "Por favor indícanos si te gustaría recibir orientación para realizar el cambio de nombre y/o sexo en tu documento de identidad.",
        _both("CASE o_orderkey % 2 WHEN 0 THEN 'Sí' ELSE 'No' END"),
    ),
    ("¿Perteneces a la Universidad del Valle?", _both("'Sí'")),
    ("Estamento", _both("c_mktsegment")),
    ("Sede de la universidad a la que pertenece", _both("n_name")),
    ("Nombre del programa académico", _both("concat('Programa ', CAST(o_custkey % 40 AS STRING))")),
    (
        "Semestre académico",
        _both("CASE WHEN o_orderkey % 29 = 0 THEN 'X' WHEN o_orderkey % 31 = 0 THEN '5d' ELSE CAST(1 + o_orderkey % 10 AS STRING) END"),
    ),
    ("¿Cuál es tu ocupación actual?", _both("CASE o_orderkey % 3 WHEN 0 THEN 'Estudiante' WHEN 1 THEN 'Empleado/a/e' ELSE 'Independiente' END")),
    ("Si eres empleado/a/e o independiente ¿A qué te dedicas específicamente?", _both("CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Docencia' END")),
    (
        "¿En los últimos 3 meses has recibido alguno de los siguientes tipos de acompañamiento/orientación de acuerdo con tu situación, experiencia o proceso personal en otro espacio, colectivo, organización privada o servicio de salud?",
        _both("CASE o_orderkey % 2 WHEN 0 THEN 'Ninguno' ELSE 'Psicológico' END"),
    ),
    ("¿En qué tipo de entidad recibiste el acompañamiento?", _both("CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'EPS' END")),
    ("¿Qué profesional le brindó la atención?", _both("CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'Psicología' END")),
    ("¿Cuál(es) es/son tu(s) fuente(s) de ingresos?", _both("CASE o_orderkey % 3 WHEN 0 THEN 'Familia' WHEN 1 THEN 'Trabajo' ELSE 'Beca' END")),
    ("¿Con quién(es) vives?", _both("CASE o_orderkey % 4 WHEN 0 THEN 'Familia' WHEN 1 THEN 'Sola/o/e' WHEN 2 THEN 'Amigos' ELSE 'Pareja' END")),
    ("Redes de apoyo (Identifica con quiénes o con qué apoyos cuentas)", _both("'Familia, amigos'")),
    ("Factores de riesgo (identifica aquello que puede estar poniéndote en riesgo)", _both("CASE WHEN o_orderkey % 6 = 0 THEN 'Ninguno' ELSE 'Económicos' END")),
    ("¿Tienes alguna creencia religiosa? ¿Cuál es?", _both("CASE WHEN o_orderkey % 5 = 0 THEN 'Sí, católica' ELSE 'No' END")),
    (
        "¿Cómo te enteraste de los servicios de Campus Diverso?",
        _both("CASE o_orderkey % 3 WHEN 0 THEN 'Redes sociales' WHEN 1 THEN 'Amigos' ELSE ' Correo  institucional ' END"),
    ),
    ("Unnamed: 60", _both("CAST(NULL AS STRING)")),
]

FORM_HEADERS = [h for h, _ in FORM_COLUMNS if h not in ("file_id", "respondent_id")]


def _q_duck(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _q_spark(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def survey_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw form export rows (raw headers as column names) from the driver tables.

    orders x customer is the only data-sized join (sort-merge on the customer
    key at scale); nation and region are dimension tables that Catalyst
    broadcasts through its size-checked threshold.
    """
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    return joined.selectExpr(*[f"{sql[0]} AS {_q_spark(h)}" for h, sql in FORM_COLUMNS])


def survey_form_sql() -> str:
    """DuckDB body of the same derivation (use as a CTE)."""
    cols = ",\n  ".join(f"{sql[1]} AS {_q_duck(h)}" for h, sql in FORM_COLUMNS)
    return (
        "SELECT\n  " + cols + "\nFROM orders JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
    )


# ---------------------------------------------------------------------------
# Header tables
# ---------------------------------------------------------------------------

UNKNOWN_TEMPLATE = ["ID", "Nombre completo", "Correo", "Observaciones", "Fecha"]

# Cleaned 2024-style export: some headers replaced by known older variants,
# birth date and employment detail absent.
_ALIAS_2024 = {
    "Estrato socioeconómico": "Estrato",
    "Ciudad, municipio o corregimiento de nacimiento": "Ciudad nacimiento",
    "Departamento de nacimiento": "Departamento",
    "Zona de residencia": "Zona residencia",
    "Barrio de residencia": "Barrio residencia",
    "Nombre del programa académico": "Nombre y código del programa académico",
    "¿Cuál es tu ocupación actual?": "Ocupación",
    "Como te enteraste de Campus Diverso": "Como te enterasta de Campus Diverso",
}


def _cleaned_2024() -> list[str]:
    out = []
    for h in C.CLEANED_COLUMNS:
        if h in ("Fecha de nacimiento", "Si eres empleado/a/e o independiente ¿A qué te dedicas específicamente?"):
            continue
        out.append(_ALIAS_2024.get(h, h))
    return out


TEMPLATES = {
    0: C.RAW_COLUMNS,
    1: C.CLEANED_COLUMNS,
    2: _cleaned_2024(),
    3: UNKNOWN_TEMPLATE,
}

# Header removed when a file "misses one mandatory header" (per template).
_DROPPED = {0: "Estamento", 1: "Estamento", 2: "Estamento", 3: "Correo"}


def _strip_accents(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


def _render(header: str, variant: str) -> str:
    if variant == "upper":
        return header.upper()
    if variant == "plain":
        return _strip_accents(header)
    return header


def template_rows() -> list[tuple[int, str, int, str, bool, bool]]:
    """(template, variant, pos, header, droppable, extra) for every variant."""
    rows = []
    for tpl, headers in TEMPLATES.items():
        for variant in ("orig", "upper", "plain"):
            for pos, h in enumerate(headers, start=1):
                rows.append((tpl, variant, pos, _render(h, variant), h == _DROPPED[tpl], False))
            # an empty trailing header (spreadsheet name), present only in some files
            rows.append((tpl, variant, len(headers) + 1, f"Unnamed: {len(headers)}", False, True))
    return rows


TEMPLATE_SCHEMA = "tpl int, variant string, pos int, header string, droppable boolean, extra boolean"

# file_id -> variant rule, shared by both engines
_VARIANT_SQL = "CASE WHEN c_custkey % 5 = 0 THEN 'upper' WHEN c_custkey % 7 = 0 THEN 'plain' ELSE 'orig' END"
_TPL_SQL = "CAST(c_custkey % 4 AS INT)"
_POS_SQL = (
    "CASE WHEN c_custkey % 13 = 0 AND t.pos = 2 THEN 3 WHEN c_custkey % 13 = 0 AND t.pos = 3 THEN 2 ELSE t.pos END"
)
_KEEP_SQL = (
    "(NOT (t.droppable AND f.c_custkey % 11 = 0)) "
    "AND (NOT t.extra OR f.c_custkey % 3 = 0)"
)


def _templates_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(template_rows(), TEMPLATE_SCHEMA)


def file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header list per customer: ``(file_id, pos, header)``.

    Customers join the template table on (template, variant), an equi-join
    whose small side is the fixed template table (a few hundred rows, so a
    broadcast with a proven bound).
    """
    files = read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{_TPL_SQL} AS tpl", f"{_VARIANT_SQL} AS variant"
    ).alias("f")
    t = F.broadcast(_templates_df(spark)).alias("t")
    joined = files.join(t, (F.col("f.tpl") == F.col("t.tpl")) & (F.col("f.variant") == F.col("t.variant")))
    return joined.where(F.expr(_KEEP_SQL)).select(
        F.col("f.c_custkey").alias("file_id"),
        F.expr(_POS_SQL.replace("c_custkey", "f.c_custkey")).cast("int").alias("pos"),
        F.col("t.header").alias("header"),
    )


def sql_str(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'"


def values_sql(rows: list[tuple], columns: list[str]) -> str:
    """A DuckDB ``(VALUES ...) AS t(cols)`` literal."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, float):
            return f"CAST('{v!r}' AS DOUBLE)"
        if isinstance(v, int):
            return repr(v)
        return sql_str(v)

    body = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}\n) AS {columns[0]}({', '.join(columns[1:])})"


def file_headers_sql() -> str:
    tv = values_sql(template_rows(), ["t", "tpl", "variant", "pos", "header", "droppable", "extra"])
    return (
        f"SELECT f.c_custkey AS file_id, CAST({_POS_SQL.replace('c_custkey', 'f.c_custkey')} AS INTEGER) AS pos, "
        f"t.header AS header\n"
        f"FROM (SELECT c_custkey, {_TPL_SQL} AS tpl, {_VARIANT_SQL} AS variant FROM customer) f\n"
        f"JOIN {tv} ON f.tpl = t.tpl AND f.variant = t.variant\n"
        f"WHERE {_KEEP_SQL}"
    )


def write_form_exports(form: DataFrame, base: str) -> list[str]:
    """Write the derived form as CSV exports with two header layouts.

    Even export ids keep the form headers; odd ones get upper-case headers
    in reverse column order (a later year's layout).  Both halves are
    written in full.  Returns the two directories.
    """
    keys = ["file_id", "respondent_id"]
    cols = [c for c in form.columns if c not in keys]
    opts = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    even = form.where((F.col("file_id") % 2) == 0)
    odd = form.where((F.col("file_id") % 2) == 1).select(
        *keys, *[F.col(_q_spark(c)).alias(c.upper()) for c in reversed(cols)]
    )
    a, b = f"{base}/layout_a", f"{base}/layout_b"
    even.write.mode("overwrite").options(**opts).csv(a)
    odd.write.mode("overwrite").options(**opts).csv(b)
    return [a, b]


def write_lines(form: DataFrame, path: str, sep: str = ",", before: str = "", rename: dict[str, str] | None = None) -> None:
    """Write a form as CSV text, a header record first in every file.

    ``before`` stands before the header; ``rename`` gives headers as they are
    to be written.
    """
    import csv
    import io

    import pyarrow as pa

    head = io.StringIO()
    csv.writer(head, delimiter=sep, lineterminator="").writerow([(rename or {}).get(c, c) for c in form.columns])
    first = before + head.getvalue()
    cells = F.struct(*[F.col(_q_spark(c)).cast("string").alias(f"c{i}") for i, c in enumerate(form.columns)])
    lines = form.select(F.to_csv(cells, {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}).alias("value"))

    def with_header(batches):
        yield pa.RecordBatch.from_arrays([pa.array([first])], names=["value"])
        yield from batches

    lines.mapInArrow(with_header, "value string").write.text(path)
