"""Schemas and the state algebra of the score log."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD = T.StructType([T.StructField(n, t) for n, t in (
    ("tweet_id", T.StringType()), ("slug", T.StringType()), ("aplicable", T.BooleanType()), ("nivel", T.StringType()), ("puntaje", T.DoubleType()),
    ("justificacion", T.StringType()), ("estado", T.StringType()), ("detalle", T.StringType()), ("contexto_incompleto", T.StringType()),
)])
TRANSLATION = T.StructType([T.StructField(n, t) for n, t in (
    ("tweet_id", T.StringType()), ("idioma_detectado", T.StringType()), ("ya_esta_en_espanol", T.BooleanType()), ("traduccion", T.StringType()),
    ("estado", T.StringType()), ("detalle", T.StringType()),
)])
TIDY = ("tweet_id", "id_criterio", "slug", "criterio", "aplicable", "nivel", "puntaje", "justificacion", "estado", "detalle", "contexto_incompleto")

# The states of the score log.
RESULT_STATES = ("OK", "NO_APLICABLE", "BLOQUEADO")
LEVEL_STATES = ("OK",)
FAILED_STATES = ("FUERA_DE_ESCALA", "LIMITE_TASA", "ERROR_SERVIDOR", "TIEMPO_AGOTADO", "SIN_RESPUESTA", "ERROR", "PERMANENTE")
#: What each resumption scope keeps.
SCOPES = {"fallidos": RESULT_STATES, "sin-nivel": LEVEL_STATES, "todo": ()}


def kept_states(scope: str) -> tuple[str, ...]:
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope!r}; one of {', '.join(SCOPES)}")
    return SCOPES[scope]
