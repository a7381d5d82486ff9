"""The expected result of every query, as SQL over the test tables.

The texts state clean values directly instead of parsing dirty ones, and round with integer
arithmetic instead of decimals, so they share no method with the code they check.
"""

from __future__ import annotations

FLAT = """
    SELECT o.o_orderkey, o.o_orderdate, n.n_nationkey, n.n_name AS estado,
           CAST(year(o.o_orderdate) AS INTEGER) AS anio,
           c.c_mktsegment AS tipo_fenomeno, o.o_orderstatus AS tipo_evento,
           CAST(COALESCE(l.n_lines, 0) AS INTEGER) AS municipios_afectados,
           CAST(COALESCE(l.quantity, 0) AS DECIMAL(18,2)) AS poblacion_afectada,
           CAST(COALESCE(l.filled, 0) AS DECIMAL(18,2)) AS poblacion_atendida,
           CAST(o.o_totalprice AS DECIMAL(18,2)) AS costo_total,
           1 AS cantidad_eventos
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN (
        SELECT l_orderkey, COUNT(*) AS n_lines,
               SUM(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
               SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS filled
        FROM lineitem GROUP BY l_orderkey
    ) l ON o.o_orderkey = l.l_orderkey
"""


def over_flat(query: str) -> str:
    return f"WITH flat AS ({FLAT}) {query}"


def whole(amount: str) -> str:
    """A non-negative amount rounded to a whole number."""
    return f"CAST((CAST({amount} * 100 AS HUGEINT) + 50) // 100 AS BIGINT)"


def millions(amount: str) -> str:
    """A non-negative amount in millions with two decimals."""
    return f"CAST((CAST({amount} * 100 AS HUGEINT) + 500000) // 1000000 AS DOUBLE) / 100"


def percent(part: str, base: str, decimals: int) -> str:
    """100 * part / base rounded half away from zero; NULL for a zero base."""
    scale = 10**decimals
    part, base = f"CAST({part} AS HUGEINT)", f"CAST({base} AS HUGEINT)"
    rounded = f"(ABS({part}) * {200 * scale} + {base}) // NULLIF(2 * {base}, 0)"
    return f"CAST(SIGN({part}) * ({rounded}) AS DOUBLE) / {scale}"


BEFORE, DURING, AFTER = "anio < 1998", "anio IN (1998, 1999)", "anio >= 2000"


def count_in(period: str, measure: str = "cantidad_eventos") -> str:
    return f"CAST(SUM(CASE WHEN {period} THEN {measure} ELSE 0 END) AS BIGINT)"


PERIOD_COMPARISON = f"""
    SELECT *, eventos_postpandemia - eventos_pandemia AS diferencia_absoluta,
           CASE WHEN eventos_postpandemia > eventos_pandemia THEN 'AUMENTO'
                WHEN eventos_postpandemia < eventos_pandemia THEN 'DISMINUCIÓN'
                ELSE 'SIN CAMBIO' END AS tendencia
    FROM (
        SELECT estado, tipo_evento, tipo_fenomeno,
               {count_in(DURING)} AS eventos_pandemia,
               {count_in(AFTER)} AS eventos_postpandemia,
               CAST(COUNT(*) AS BIGINT) AS total_historico,
               {count_in(AFTER, "municipios_afectados")} AS municipios_postpandemia,
               {whole(f"SUM(CASE WHEN {AFTER} THEN poblacion_afectada ELSE 0 END)")}
                   AS poblacion_postpandemia
        FROM flat GROUP BY ALL
    )
"""
YEARLY_EVOLUTION = f"""
    SELECT *, total_eventos - eventos_anio_anterior AS delta_eventos,
           {percent("(total_eventos - eventos_anio_anterior)", "eventos_anio_anterior", 1)}
               AS variacion_pct,
           CASE WHEN anio < 1998 THEN 'Pre-pandemia' WHEN anio <= 1999 THEN 'Pandemia'
                ELSE 'Post-pandemia' END AS periodo
    FROM (
        SELECT *, LAG(total_eventos) OVER (PARTITION BY tipo_evento ORDER BY anio)
                   AS eventos_anio_anterior
        FROM (
            SELECT anio, tipo_evento, CAST(COUNT(*) AS BIGINT) AS total_eventos,
                   CAST(SUM(municipios_afectados) AS BIGINT) AS total_municipios,
                   {whole("SUM(poblacion_afectada)")} AS total_poblacion,
                   {millions("SUM(costo_total)")} AS costo_millones_mxn
            FROM flat GROUP BY anio, tipo_evento
        )
    )
"""
STATE_RANKING = f"""
    SELECT CAST(RANK() OVER (ORDER BY total_eventos DESC) AS BIGINT) AS ranking_total,
           CAST(DENSE_RANK() OVER (ORDER BY eventos_postpandemia DESC) AS BIGINT)
               AS ranking_postpandemia,
           CAST(DENSE_RANK() OVER (ORDER BY eventos_pandemia DESC) AS BIGINT) AS ranking_pandemia,
           *,
           CAST(DENSE_RANK() OVER (ORDER BY eventos_pandemia DESC)
                - DENSE_RANK() OVER (ORDER BY eventos_postpandemia DESC) AS BIGINT)
               AS cambio_ranking
    FROM (
        SELECT estado, CAST(COUNT(*) AS BIGINT) AS total_eventos,
               {count_in(BEFORE)} AS eventos_pre_pandemia,
               {count_in(DURING)} AS eventos_pandemia,
               {count_in(AFTER)} AS eventos_postpandemia,
               CAST(SUM(municipios_afectados) AS BIGINT) AS total_municipios,
               {whole("SUM(poblacion_afectada)")} AS total_poblacion,
               {millions("SUM(costo_total)")} AS costo_millones_mxn
        FROM flat GROUP BY estado
    )
"""
POSTPERIOD_GROWTH = f"""
    SELECT *, CASE WHEN eventos_pandemia = 0 AND eventos_postpandemia > 0
                       THEN 'NUEVO POST-PANDEMIA'
                   WHEN incremento_pct > 50 THEN 'INCREMENTO ALTO (>50%)'
                   WHEN incremento_pct >= 10 THEN 'INCREMENTO MODERADO'
                   WHEN incremento_pct < 0 THEN 'REDUCCIÓN'
                   ELSE 'ESTABLE' END AS clasificacion
    FROM (
        SELECT *, eventos_postpandemia - eventos_pandemia AS incremento_absoluto,
               {percent("(eventos_postpandemia - eventos_pandemia)", "eventos_pandemia", 1)}
                   AS incremento_pct
        FROM (
            SELECT estado, tipo_fenomeno,
                   {count_in(DURING)} AS eventos_pandemia,
                   {count_in(AFTER)} AS eventos_postpandemia,
                   CAST(COUNT(*) AS BIGINT) AS total_eventos
            FROM flat GROUP BY estado, tipo_fenomeno HAVING COUNT(*) >= 3
        )
    )
"""
PARETO = f"""
    SELECT * EXCLUDE (nation_total),
           {percent("total_eventos", "nation_total", 2)} AS pct_nacional,
           {percent("eventos_acumulados", "nation_total", 1)} AS pct_acumulado,
           CASE WHEN {percent("eventos_acumulados", "nation_total", 1)} <= 80
                THEN 'TOP 80% de eventos' ELSE 'Resto' END AS grupo_pareto
    FROM (
        SELECT a.estado, a.total_eventos, a.poblacion_afectada,
               (SELECT COUNT(*) FROM orders) AS nation_total,
               CAST(SUM(b.total_eventos) AS BIGINT) AS eventos_acumulados
        FROM per_state a JOIN per_state b
          ON b.total_eventos > a.total_eventos
          OR (b.total_eventos = a.total_eventos AND b.estado <= a.estado)
        GROUP BY ALL
    )
"""
PER_STATE = f"""
    SELECT estado, CAST(COUNT(*) AS BIGINT) AS total_eventos,
           {whole("SUM(poblacion_afectada)")} AS poblacion_afectada
    FROM flat GROUP BY estado
"""


def over_states(query: str) -> str:
    return f"WITH flat AS ({FLAT}), per_state AS ({PER_STATE}) {query}"


def spelled(column: str, count: int, cases: dict[str, str]) -> str:
    """The clean value per spelling: ``cases`` maps spelling positions to SQL, others are NULL."""
    arms = " ".join(
        f"WHEN {column} % {count} IN ({positions}) THEN {value}" for positions, value in cases.items()
    )
    return f"CASE {arms} END"


KEY = "o_orderkey"
STATE = spelled(KEY, 8, {"0,1,2,3,4,5": "estado", "6": "'SIN DATO'"})
KNOWN_STATE = f"{KEY} % 8 < 6"


def year_of(year: str) -> str:
    return f"CAST({spelled(KEY, 9, {'0,1,2,3,7,8': year})} AS INTEGER)"


def phenomenon_of(segment: str) -> str:
    # The three listed segments have a canonical name, the other two are title-cased.
    title = f"upper({segment}[1]) || lower({segment}[2:])"
    listed = (
        f"CASE {segment} WHEN 'AUTOMOBILE' THEN 'Automóvil' WHEN 'BUILDING' THEN 'Edificio' "
        f"WHEN 'FURNITURE' THEN 'Mueble' ELSE {title} END"
    )
    return spelled(
        KEY,
        11,
        {
            "0,1,2,10": listed,
            "7": f"{title} || ' (Tipo)-Dos'",
            "8": f"{title} || '/2Da Fase'",
        },
    )


def count_of(count: str) -> str:
    return f"CAST(CASE WHEN {KEY} % 5 IN (0, 1, 2) THEN {count} ELSE 0 END AS INTEGER)"


def number_of(amount: str) -> str:
    return f"CAST({spelled(KEY, 9, {'0,1,2,6,8': amount})} AS DECIMAL(18,2))"


def money_of(amount: str) -> str:
    return f"CAST({spelled(KEY, 7, {'0,6': amount})} AS DECIMAL(18,2))"


PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
ZERO = "CAST(0 AS DECIMAL(18,2))"



def content_id(*columns: str) -> str:
    """63 bits of the digest of the columns' texts, each after its length."""
    texts = [f"COALESCE(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in columns]
    return f"(('0x' || md5({' || '.join(texts)})[1:16])::UBIGINT % 9223372036854775808)::BIGINT"


def losses(event_type: str, column: str, source: str, cases: dict[str, str]) -> str:
    """Rows ``(tipo_evento, columna, motivo, n)`` of a staging column: ``cases`` maps reasons to conditions."""
    return " UNION ALL ".join(
        f"SELECT '{event_type}' AS tipo_evento, '{column}' AS columna, '{reason}' AS motivo, "
        f"CAST(COUNT(*) AS BIGINT) AS n FROM {source} WHERE {condition} HAVING COUNT(*) > 0"
        for reason, condition in cases.items()
    )


NO_YEAR = {"no_number": "o_orderkey % 9 = 5", "unfit": "o_orderkey % 9 = 4"}
NO_COUNT = {"no_number": "o_orderkey % 5 = 4"}
NO_AMOUNT = {"no_number": "o_orderkey % 9 IN (3, 4, 7)"}
LARGE_COUNT = {"no_number": "o_orderkey % 5 = 4 AND o_orderkey % 7 <> 0", "unfit": "o_orderkey % 7 = 0"}
DECLARED_AS = "(SELECT f.o_orderkey FROM orders f JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = '{}')"

DISASTERS = f"""
    SELECT o_orderkey, estado, {year_of("anio")} AS anio,
           {phenomenon_of("tipo_fenomeno")} AS fenomeno, 'Desastre' AS tipo_evento,
           {count_of("municipios_afectados")} AS municipios_afectados,
           {ZERO} AS poblacion_afectada, {ZERO} AS poblacion_atendida, {ZERO} AS costo_total,
           1 AS cantidad_eventos
    FROM flat WHERE tipo_evento = 'F'
"""
EMERGENCIES = f"""
    SELECT o_orderkey, estado, {year_of("anio")} AS anio,
           {phenomenon_of("tipo_fenomeno")} AS fenomeno, 'Emergencia' AS tipo_evento,
           {count_of("municipios_afectados")} AS municipios_afectados,
           {number_of("poblacion_afectada * 1000")} AS poblacion_afectada,
           {number_of("poblacion_atendida * 1000")} AS poblacion_atendida,
           {money_of("costo_total")} AS costo_total, 1 AS cantidad_eventos
    FROM flat WHERE tipo_evento = 'O'
"""
PREVENTION_PHENOMENON = """
    CASE WHEN o_orderkey % 3 IN (0, 2) THEN
        CASE tipo_fenomeno WHEN 'AUTOMOBILE' THEN 'Automóvil' WHEN 'BUILDING' THEN 'Edificio'
             WHEN 'FURNITURE' THEN 'Mueble'
             ELSE upper(tipo_fenomeno[1]) || lower(tipo_fenomeno[2:]) END
    END
"""
PREVENTION = f"""
    SELECT o_orderkey, estado, {year_of("anio")} AS anio, {PREVENTION_PHENOMENON} AS fenomeno,
           'Preventivo' AS tipo_evento, 0 AS municipios_afectados,
           {number_of("poblacion_afectada * 1000")} AS poblacion_afectada,
           {ZERO} AS poblacion_atendida, {money_of("costo_total")} AS costo_total,
           1 AS cantidad_eventos
    FROM flat WHERE tipo_evento = 'P'
"""
# All declarations, the ones with a known state, and the ones a load keeps.
DECLARED = f"""
    flat AS ({FLAT}),
    declared AS ({DISASTERS} UNION ALL {EMERGENCIES}),
    known AS (SELECT * FROM declared WHERE {KNOWN_STATE}),
    base AS (SELECT * FROM known WHERE anio BETWEEN 1996 AND 2001)
"""
KEYED = f"""
    {DECLARED},
    states AS (SELECT estado, row_number() OVER (ORDER BY estado) AS id FROM base GROUP BY estado),
    years AS (SELECT anio, row_number() OVER (ORDER BY anio) AS id FROM base GROUP BY anio),
    kinds AS (SELECT fenomeno, row_number() OVER (ORDER BY fenomeno) AS id
              FROM base WHERE fenomeno IS NOT NULL GROUP BY fenomeno),
    fact AS (
        SELECT {content_id("o_orderkey")} AS id_evento, o_orderkey, CAST(states.id AS INTEGER) AS id_estado,
               CAST(years.id AS INTEGER) AS id_tiempo, CAST(kinds.id AS INTEGER) AS id_fenomeno,
               CASE tipo_evento WHEN 'Desastre' THEN 1 ELSE 2 END AS id_tipo_evento,
               municipios_afectados, poblacion_afectada, poblacion_atendida, costo_total,
               cantidad_eventos
        FROM base LEFT JOIN states USING (estado) LEFT JOIN years USING (anio)
                  LEFT JOIN kinds USING (fenomeno)
    )
"""


def checks(source: str, rules: dict[str, str]) -> str:
    """``(check, n)`` rows counting the rows of ``source`` each rule matches."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", CAST(COUNT(*) AS BIGINT) AS n FROM {source} WHERE {rule}"""
        for name, rule in rules.items()
    )


def metric(name: str, value: str, source: str, text: str | None = None) -> str:
    text = text or f"format('{{:,}}', CAST({value} AS BIGINT))"
    return (
        f"SELECT '{name}' AS metric, CAST({value} AS DECIMAL(38,2)) AS value, {text} AS texto "
        f"FROM {source}"
    )


CENTS = "CAST(SUM(costo_total) * 100 AS BIGINT)"
COST_TEXT = f"'$' || format('{{:,}}', {CENTS} // 100) || '.' || lpad(CAST({CENTS} % 100 AS VARCHAR), 2, '0')"
MEASURE_LIST = [
    "municipios_afectados",
    "poblacion_afectada",
    "poblacion_atendida",
    "costo_total",
    "cantidad_eventos",
]
SOURCES = {"desastres": "F", "emergencias": "O", "proyectos": "P"}

ORACLE: dict[str, str] = {
    "period_comparison": over_flat(PERIOD_COMPARISON),
    "yearly_evolution": over_flat(YEARLY_EVOLUTION),
    "state_ranking": over_flat(STATE_RANKING),
    "postperiod_growth": over_flat(POSTPERIOD_GROWTH),
    "pareto": over_states(PARETO),
    "pareto_state_count": over_states(
        f"SELECT CAST(COUNT(*) AS BIGINT) AS estados_top80 FROM ({PARETO}) WHERE pct_acumulado <= 80"
    ),
    "top10_state_year": over_flat(
        """
        SELECT estado, anio, CAST(COUNT(*) AS BIGINT) AS total_eventos,
               CAST(SUM(municipios_afectados) AS BIGINT) AS municipios_afectados,
               CAST(SUM(poblacion_afectada) AS DECIMAL(38,2)) AS poblacion_afectada,
               CAST(SUM(costo_total) AS DECIMAL(38,2)) AS costo_total
        FROM flat GROUP BY estado, anio ORDER BY total_eventos DESC, estado, anio LIMIT 10
        """
    ),
    "star_cube_top20": over_flat(
        """
        SELECT estado, anio, tipo_fenomeno, tipo_evento, CAST(COUNT(*) AS BIGINT) AS total_eventos
        FROM flat GROUP BY ALL
        ORDER BY total_eventos DESC, estado, anio, tipo_fenomeno, tipo_evento LIMIT 20
        """
    ),
    "fact_totals": over_flat(
        f"""
        SELECT CAST(COUNT(*) AS BIGINT) AS registros_fact, CAST(COUNT(*) AS BIGINT) AS total_eventos,
               CAST(SUM(municipios_afectados) AS BIGINT) AS municipios_afectados,
               {whole("SUM(poblacion_afectada)")} AS poblacion_afectada,
               CAST(SUM(costo_total) AS DECIMAL(38,2)) AS costo_total
        FROM flat
        """
    ),
    "kpi_cards": over_flat(
        f"""
        SELECT CAST(COUNT(*) AS BIGINT) AS total_eventos,
               {whole("SUM(poblacion_afectada)")} AS poblacion_afectada,
               CAST(SUM(municipios_afectados) AS BIGINT) AS municipios_afectados,
               CAST(COUNT(DISTINCT estado) AS BIGINT) AS estados_con_datos
        FROM flat
        """
    ),
    "top5_states_by_growth": over_flat(
        f"""
        SELECT estado, {count_in(DURING)} AS eventos_pandemia, {count_in(AFTER)} AS eventos_postpandemia,
               {count_in(AFTER)} - {count_in(DURING)} AS diferencia
        FROM flat GROUP BY estado ORDER BY diferencia DESC, estado LIMIT 5
        """
    ),
    "top5_states_total": over_flat(
        """
        SELECT CAST(RANK() OVER (ORDER BY COUNT(*) DESC) AS BIGINT) AS ranking_total, estado,
               CAST(COUNT(*) AS BIGINT) AS total_eventos
        FROM flat GROUP BY estado ORDER BY ranking_total, estado LIMIT 5
        """
    ),
    "yearly_series": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, o_orderstatus AS tipo_evento,
               CAST(COUNT(*) AS BIGINT) AS total_eventos
        FROM orders GROUP BY ALL
    """,
    "growth_by_phenomenon": over_flat(
        f"""
        SELECT tipo_fenomeno, estado, incremento_absoluto, incremento_pct
        FROM ({POSTPERIOD_GROWTH})
        """
    ),
    "period_pivot": over_flat(
        f"""
        SELECT estado, {count_in(BEFORE)} AS pre, {count_in(DURING)} AS pandemia,
               {count_in(AFTER)} AS post
        FROM flat GROUP BY estado
        """
    ),
    "dim_state": over_flat(
        """
        SELECT CAST(row_number() OVER (ORDER BY estado) AS INTEGER) AS id_estado, estado
        FROM (SELECT DISTINCT estado FROM flat)
        """
    ),
    "dim_time": """
        SELECT CAST(row_number() OVER (ORDER BY anio) AS INTEGER) AS id_tiempo, anio
        FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders
              WHERE year(o_orderdate) BETWEEN 1996 AND 2001)
    """,
    "dim_phenomenon": over_flat(
        """
        SELECT CAST(row_number() OVER (ORDER BY tipo_fenomeno) AS INTEGER) AS id_fenomeno,
               tipo_fenomeno
        FROM (SELECT DISTINCT tipo_fenomeno FROM flat)
        """
    ),
    "dim_event_type": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS id_tipo_evento,
               o_orderstatus AS tipo_evento, CAST(COUNT(*) AS BIGINT) AS eventos
        FROM orders GROUP BY o_orderstatus
    """,
    "dim_insert_if_absent": """
        SELECT CAST(row_number() OVER (ORDER BY CASE WHEN n_regionkey <= 2 THEN 0 ELSE 1 END, n_name)
                    AS INTEGER) AS id_estado, n_name AS estado
        FROM nation
        WHERE n_regionkey <= 2 OR n_nationkey IN (SELECT c_nationkey FROM customer)
    """,
    "clean_text": f"""
        SELECT o_orderkey, {spelled(KEY, 7, {
            "0,1,2,3": "o_orderpriority",
            "5": "'MICHOACÁN Ñ ' || o_orderpriority",
            "6": "'A  B ' || o_orderpriority",
        })} AS texto FROM orders
    """,
    "clean_number": f"SELECT o_orderkey, {number_of(PRICE)} AS numero FROM orders",
    "clean_money": f"SELECT o_orderkey, {money_of(PRICE)} AS monto FROM orders",
    "coerce_year": f"SELECT o_orderkey, {year_of('year(o_orderdate)')} AS anio FROM orders",
    "coerce_default_zero": f"SELECT o_orderkey, {count_of('o_custkey')} AS cantidad FROM orders",
    "conform_dimension_value": over_flat(f"SELECT o_orderkey, {STATE} AS estado FROM flat"),
    "conform_with_null_markers": over_flat(
        f"SELECT o_orderkey, {phenomenon_of('tipo_fenomeno')} AS fenomeno FROM flat"
    ),
    "conform_strict": f"""
        SELECT o_orderkey, {spelled(KEY, 4, {
            "0,1,2": "CASE o_orderstatus WHEN 'F' THEN 'Desastre' WHEN 'O' THEN 'Emergencia' END"
        })} AS tipo_evento FROM orders
    """,
    "valid_value_semi_join": over_flat(
        f"SELECT o_orderkey, estado FROM flat WHERE {KNOWN_STATE}"
    ),
    "rejected_values_anti_join": f"""
        SELECT CASE WHEN o_orderkey % 8 = 6 THEN 'SIN DATO' END AS valor,
               CAST(COUNT(*) AS BIGINT) AS n
        FROM orders WHERE o_orderkey % 8 >= 6 GROUP BY ALL
    """,
    "clean_disasters": over_flat(f"{DISASTERS} AND {KNOWN_STATE}"),
    "clean_emergencies": over_flat(f"{EMERGENCIES} AND {KNOWN_STATE}"),
    "clean_projects": over_flat(
        f"""
        SELECT o_orderkey, {STATE} AS estado, {year_of("anio")} AS anio_autorizacion,
               {number_of("poblacion_afectada * 1000")} AS personas_beneficiadas,
               {money_of("costo_total")} AS costo_total
        FROM flat WHERE tipo_evento = 'P'
        """
    ),
    "fact_base": f"WITH {DECLARED} SELECT * FROM base",
    "fact_verdicts": f"""
        WITH {DECLARED}
        SELECT tipo_evento,
               CASE WHEN o_orderkey % 8 >= 6 THEN 'unknown_state'
                    WHEN anio IS NULL OR anio NOT BETWEEN 1996 AND 2001 THEN 'year_out_of_range'
                    WHEN fenomeno IS NULL THEN 'null_phenomenon'
                    ELSE 'accepted' END AS verdict,
               CAST(COUNT(*) AS BIGINT) AS n
        FROM declared GROUP BY ALL
    """,
    "fact_load": f"WITH {KEYED} SELECT * FROM fact",
    "fact_row_ids": over_flat(
        f"""
        SELECT estado, anio, tipo_fenomeno, tipo_evento, municipios_afectados,
               {content_id("estado", "anio", "tipo_fenomeno", "tipo_evento", "municipios_afectados", "equal")} AS id_evento
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY estado, anio, tipo_fenomeno, tipo_evento, municipios_afectados
                  ORDER BY o_orderkey) - 1 AS equal FROM flat)
        """
    ),
    "parse_losses": " UNION ALL ".join(
        [
            losses("Desastre", "anio", DECLARED_AS.format("F"), NO_YEAR),
            losses("Desastre", "numero_municipios_corroborados", DECLARED_AS.format("F"), LARGE_COUNT),
            losses("Emergencia", "anio_ocurrencia_evento", DECLARED_AS.format("O"), NO_YEAR),
            losses("Emergencia", "numero_municipios_corroborados", DECLARED_AS.format("O"), NO_COUNT),
            losses("Emergencia", "poblacion_afectada", DECLARED_AS.format("O"), NO_AMOUNT),
            losses("Emergencia", "poblacion_atendida", DECLARED_AS.format("O"), NO_AMOUNT),
            losses(
                "Emergencia",
                "costo_total_declaratoria",
                DECLARED_AS.format("O"),
                {"no_number": "o_orderkey % 7 IN (1, 3, 5)"},
            ),
        ]
    ),
    "fact_verdicts_strict": f"""
        WITH {DECLARED}
        SELECT CASE WHEN o_orderkey % 8 >= 6 THEN 'unknown_state'
                    WHEN anio IS NULL OR anio NOT BETWEEN 1996 AND 2001 THEN 'year_out_of_range'
                    WHEN fenomeno IS NULL THEN 'null_phenomenon'
                    WHEN fenomeno NOT IN ('Automóvil', 'Edificio', 'Mueble') THEN 'unknown_phenomenon'
                    ELSE 'accepted' END AS verdict,
               CAST(COUNT(*) AS BIGINT) AS n
        FROM declared WHERE tipo_evento = 'Emergencia' GROUP BY ALL
    """,
    "totals_by_grain": over_flat(
        f"""
        SELECT unnest(['detalle', 'consolidado']) AS grano, * FROM (
            SELECT CAST(COUNT(*) AS BIGINT) AS registros_fact, CAST(COUNT(*) AS BIGINT) AS total_eventos,
                   CAST(SUM(municipios_afectados) AS BIGINT) AS municipios_afectados,
                   {whole("SUM(poblacion_afectada)")} AS poblacion_afectada,
                   CAST(SUM(costo_total) AS DECIMAL(38,2)) AS costo_total
            FROM flat)
        """
    ),
    "distinct_estimates": over_flat(
        " UNION ALL ".join(
            f"SELECT '{column}' AS columna, CAST(COUNT(DISTINCT {column}) AS BIGINT) AS distintos FROM flat"
            for column in ("estado", "tipo_fenomeno", "anio")
        )
    ),
    "fact_grain": over_flat(
        """
        SELECT estado, anio, tipo_fenomeno, tipo_evento,
               CAST(SUM(municipios_afectados) AS BIGINT) AS municipios_afectados,
               CAST(SUM(poblacion_afectada) AS DECIMAL(38,2)) AS poblacion_afectada,
               CAST(SUM(poblacion_atendida) AS DECIMAL(38,2)) AS poblacion_atendida,
               CAST(SUM(costo_total) AS DECIMAL(38,2)) AS costo_total,
               CAST(SUM(cantidad_eventos) AS BIGINT) AS cantidad_eventos
        FROM flat GROUP BY ALL
        """
    ),
    "fact_with_prevention": f"""
        WITH {DECLARED}, prevention AS ({PREVENTION})
        SELECT tipo_evento, CAST(COUNT(*) AS BIGINT) AS registros,
               CAST(COUNT(fenomeno) AS BIGINT) AS con_fenomeno,
               CAST(SUM(poblacion_afectada) AS DECIMAL(38,2)) AS poblacion_afectada,
               CAST(SUM(costo_total) AS DECIMAL(38,2)) AS costo_total
        FROM (SELECT * FROM base UNION ALL
              SELECT * FROM prevention WHERE {KNOWN_STATE} AND anio BETWEEN 1996 AND 2001)
        GROUP BY tipo_evento
    """,
    "dedup_latest": over_flat(
        """
        SELECT o_orderkey, o_orderdate, estado, anio, tipo_fenomeno, tipo_evento, costo_total
        FROM flat
        WHERE (estado, anio, tipo_fenomeno, o_orderkey) IN (
            SELECT (f.estado, f.anio, f.tipo_fenomeno, MAX(f.o_orderkey))
            FROM flat f
            JOIN (SELECT estado, anio, tipo_fenomeno, MAX(o_orderdate) AS last_date
                  FROM flat GROUP BY ALL) d
              ON f.estado = d.estado AND f.anio = d.anio AND f.tipo_fenomeno = d.tipo_fenomeno
             AND f.o_orderdate = d.last_date
            GROUP BY f.estado, f.anio, f.tipo_fenomeno
        )
        """
    ),
    "source_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS source, CAST(COUNT(*) AS BIGINT) AS n FROM orders "
        f"WHERE o_orderstatus = '{status}'"
        for name, status in SOURCES.items()
    ),
    "dq_null_keys": f"WITH {KEYED} "
    + checks(
        "fact",
        {
            "id_estado": "id_estado IS NULL",
            "id_tiempo": "id_tiempo IS NULL",
            "id_fenomeno": "id_fenomeno IS NULL",
            "id_tipo_evento": "id_tipo_evento IS NULL",
            "cualquiera": "id_estado IS NULL OR id_tiempo IS NULL OR id_fenomeno IS NULL "
            "OR id_tipo_evento IS NULL",
        },
    ),
    "dq_negative_measures": over_flat(
        checks("customer", {"c_acctbal": "c_acctbal < 0", "cualquiera": "c_acctbal < 0"})
        + " UNION ALL "
        + checks("flat", {measure: f"{measure} < 0" for measure in MEASURE_LIST})
    ),
    "dq_orphan_keys": checks("customer", {"c_nationkey": "c_nationkey = 3"})
    + " UNION ALL "
    + checks("supplier", {"s_nationkey": "s_nationkey = 3"})
    + " UNION ALL "
    + checks("orders", {"o_custkey": "o_custkey NOT IN (SELECT c_custkey FROM customer)"})
    + " UNION ALL "
    + checks("lineitem", {"l_orderkey": "l_orderkey NOT IN (SELECT o_orderkey FROM orders)"}),
    "dq_duplicate_keys": "SELECT 'id_evento' AS \"check\", CAST(0 AS BIGINT) AS n UNION ALL "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", CAST(COUNT(*) AS BIGINT) AS n
            FROM (SELECT {columns} FROM {source} GROUP BY ALL HAVING COUNT(*) > 1)"""
        for name, source, columns in [
            ("n_nationkey", "nation", "n_nationkey"),
            ("n_name", "nation", "n_name"),
            ("o_orderkey", "orders", "o_orderkey"),
            ("o_custkey", "orders", "o_custkey"),
            ("l_line", "lineitem", "l_orderkey, l_linenumber"),
        ]
    ),
    "dq_text_length": checks(
        "part",
        {
            "p_name": "length(p_name) > 8",
            "p_brand": "length(p_brand) > 100",
            "p_type": "length(p_type) > 5",
        },
    ),
    "dq_fact_checks": f"WITH {KEYED} "
    + checks(
        "fact",
        {
            "negative measures": " OR ".join(f"{measure} < 0" for measure in MEASURE_LIST),
            "null id_estado": "id_estado IS NULL",
            "orphan id_estado": "id_estado = 2",
            "null id_tiempo": "id_tiempo IS NULL",
            "orphan id_tiempo": "false",
            "null id_fenomeno": "id_fenomeno IS NULL",
            "orphan id_fenomeno": "id_fenomeno = 1",
            "null id_tipo_evento": "id_tipo_evento IS NULL",
            "orphan id_tipo_evento": "false",
        },
    ),
    "quality_metrics": f"WITH {DECLARED} "
    + " UNION ALL ".join(
        [
            *[
                metric(f"leidos_{name}", "COUNT(*)", f"orders WHERE o_orderstatus = '{status}'")
                for name, status in SOURCES.items()
            ],
            metric("registros_fact", "COUNT(*)", "base"),
            metric("estados", "COUNT(DISTINCT estado)", "base"),
            metric("fenomenos", "COUNT(DISTINCT fenomeno)", "base"),
            metric("tipos_evento", "COUNT(DISTINCT tipo_evento)", "base"),
            metric("municipios_afectados", "SUM(municipios_afectados)", "base"),
            metric("poblacion_afectada", "SUM(poblacion_afectada)", "base"),
            metric("poblacion_atendida", "SUM(poblacion_atendida)", "base"),
            metric("costo_total", "SUM(costo_total)", "base", COST_TEXT),
        ]
    ),
    "integrity_null_counts": f"WITH {DECLARED} "
    + " UNION ALL ".join(
        f"SELECT '{column}' AS metric, CAST(COUNT(*) AS BIGINT) AS value FROM base "
        f"WHERE {column} IS NULL"
        for column in ["estado", "anio", "fenomeno", "tipo_evento"]
    ),
}
