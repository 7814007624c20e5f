"""Hard gates over candidates. They are column expressions; no row leaves the JVM."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions.tokens import (
    ESCAPES,
    MECHANISMS,
    control_sql,
    curly_kind_sql,
    curly_sql,
    escape_messages_sql,
    multiset_messages_sql,
    occurrences_sql,
    stray_sql,
    tokens_sql,
    xml_messages_sql,
)

PLACEHOLDERS = ("positional", "named")
ALL_GATES = ("positional", "named", "rulepack", "richtext", "escape", "xml")


def validate(
    df: DataFrame,
    gates: tuple[str, ...] = ALL_GATES,
    source: str = "source_text",
    output: str = "translated_text",
) -> DataFrame:
    """Add ``failures``, ``passed`` and ``validation_status``.

    A row without a translation fails, with its ``error`` as the message if the input has one.
    Both texts enter one expression once: lambdas search them (tokens, escapes), derive measures
    and compare the measures. So every regular expression runs once per text, also
    when the optimizer copies the expression into a filter further down.
    """
    # found: what is searched in the texts; measured: what is derived from it.
    found, measured, parts, passed = {}, {}, [], []
    for gate in gates:
        if gate in MECHANISMS:
            for side in "so":
                if gate in PLACEHOLDERS:
                    found[f"{side}_curly"] = curly_sql(f"p.{side}")
                    measured[f"{side}_{gate}"] = curly_kind_sql(gate, f"f.{side}_curly")
                else:
                    found[f"{side}_{gate}"] = tokens_sql(gate, f"p.{side}")
                    measured[f"{side}_{gate}"] = f"f.{side}_{gate}"
            a, b = f"m.s_{gate}", f"m.o_{gate}"
            parts.append(multiset_messages_sql(gate, a, b))
            passed.append(f"sort_array({a}) = sort_array({b})")
        elif gate == "escape":
            for side in "so":
                for name, needle in ESCAPES.items():
                    found[f"{side}_{name}"] = occurrences_sql(f"p.{side}", needle)
                    measured[f"{side}_{name}"] = f"f.{side}_{name}"
            parts.append(escape_messages_sql("m.s_", "m.o_"))
            passed.append(
                "m.s_escaped = m.o_escaped and m.o_newlines <= m.s_newlines"
                " and m.o_doubled <= m.s_doubled"
            )
        elif gate == "xml":
            for side in "so":
                found[f"{side}_richtext"] = tokens_sql("richtext", f"p.{side}")
                measured[f"{side}_stray"] = stray_sql(f"f.{side}", f"f.{side}_richtext")
            found |= {"s": "p.s", "o": "p.o"}
            measured["o_control"] = control_sql("f.o")
            parts.append(xml_messages_sql("m.s_", "m.o_"))
            passed.append("m.o_stray <= m.s_stray and not m.o_control")
        else:
            raise ValueError(f"unknown gate: {gate}")
    kept = [c for c in df.columns if c not in ("failures", "passed", "validation_status")]
    step = lambda fields: ", ".join(f"'{n}', {text}" for n, text in fields.items())
    ok = " and ".join(f"({p})" for p in passed)
    outcome = (
        f"element_at(transform(transform(transform(array(named_struct('s', {source}, 'o', "
        f"{output})), p -> named_struct({step(found)})), f -> named_struct({step(measured)})), "
        f"m -> named_struct('failures', concat({', '.join(parts)}), 'passed', {ok})), 1)"
    )
    reason = "coalesce(concat('error ', error), 'missing translation')" if "error" in df.columns else "'missing translation'"
    present = f"{output} is not null"
    return df.selectExpr(*kept, f"if({present}, {outcome}, null) as _outcome").selectExpr(
        *kept,
        f"coalesce(_outcome.failures, if({present}, cast(array() as array<string>), array({reason}))) as failures",
        "coalesce(_outcome.passed, false) as passed",
        "if(coalesce(_outcome.passed, false), 'passed', 'failed') as validation_status",
    )


def require_filled(
    validated: DataFrame, source: str = "source_text", output: str = "translated_text"
) -> DataFrame:
    """Fail rows whose source has text while the translation is empty."""
    empty = (F.trim(source) != "") & (F.trim(output) == "")
    bad = F.coalesce(empty, F.lit(False))
    return validated.withColumns(
        {
            "failures": F.when(bad, F.concat("failures", F.array(F.lit("empty translation")))).otherwise(
                F.col("failures")
            ),
            "passed": F.col("passed") & ~bad,
            "validation_status": F.when(bad, "failed").otherwise(F.col("validation_status")),
        }
    )


def check_placeholders(df: DataFrame) -> DataFrame:
    """The positional and named gates only."""
    return validate(df, PLACEHOLDERS)


def revalidate_tm(tm: DataFrame, gates: tuple[str, ...] = ALL_GATES) -> DataFrame:
    """Gates over stored rows; ``changed`` marks rows whose stored status no longer holds."""
    stored = tm.withColumn("stored_status", F.col("validation_status"))
    return validate(stored, gates, output="translation").withColumn(
        "changed", F.col("stored_status") != F.col("validation_status")
    )
