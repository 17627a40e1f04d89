"""DuckDB oracle for the change audit (Q30): events stream and curated tables."""

from __future__ import annotations

from .adapter import with_ctes
from .queries import AS_OF

AUDIT_CUTOFF = "2024-01-15 00:00:00"


def _img(a: str) -> str:
    return f"CAST(to_json({{'user_id': {a}.user_id, 'evento': {a}.evento, 'valor': {a}.valor, 'k': {a}.k}}) AS VARCHAR)"


def _snap(where: str) -> str:
    return f"""SELECT user_id, event_type AS evento, CAST(value AS DOUBLE) AS valor,
                      CAST(json_extract(props, '$.k') AS INTEGER) AS k
               FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                     FROM events {where})
               WHERE rn = 1 AND event_type <> 'error'"""


AUDIT_SNAPSHOTS = f"""
WITH s_old AS ({_snap(f"WHERE ts <= TIMESTAMP '{AUDIT_CUTOFF}'")}),
     s_new AS ({_snap("")})
SELECT 'usuario' AS tabela_afetada,
       CASE WHEN o.user_id IS NULL THEN 'I' WHEN n.user_id IS NULL THEN 'D' ELSE 'U' END AS operacao,
       CASE WHEN o.user_id IS NOT NULL AND n.user_id IS NOT NULL OR n.user_id IS NULL THEN {_img('o')} END
           AS dados_antigos,
       CASE WHEN n.user_id IS NOT NULL THEN {_img('n')} END AS dados_novos
FROM s_old o FULL JOIN s_new n ON o.user_id = n.user_id
WHERE o.user_id IS NULL OR n.user_id IS NULL OR o.evento IS DISTINCT FROM n.evento
   OR o.valor IS DISTINCT FROM n.valor OR o.k IS DISTINCT FROM n.k"""

AUDIT_EVENTS = """
WITH ev AS (
  SELECT user_id, ts, event_id,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         CAST(to_json({'user_id': user_id, 'evento': event_type, 'valor': CAST(value AS DOUBLE),
                  'k': CAST(json_extract(props, '$.k') AS INTEGER)}) AS VARCHAR) AS img
  FROM events),
lg AS (
  SELECT *, lag(op) OVER w AS pop, lag(img) OVER w AS pimg
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT 'usuario' AS tabela_afetada, op AS operacao,
       CASE WHEN op <> 'I' AND pop IS NOT NULL AND pop <> 'D' THEN pimg END AS dados_antigos,
       CASE WHEN op <> 'D' THEN img END AS dados_novos
FROM lg"""

def _n_img(a: str) -> str:
    cols = ["notificacao_id", "source_id", "data_notificacao", "municipio_notificacao_ibge",
            "estado_notificacao_ibge", "excluido", "validado"]
    return "CAST(to_json({" + ", ".join(f"'{c}': {a}.{c}" for c in cols) + "}) AS VARCHAR)"


AUDIT_NOTIFICACAO = with_ctes([
    ("n_old", f"SELECT * FROM notificacao WHERE data_notificacao <= DATE '{AS_OF}'"),
    ("n_new", "SELECT * FROM notificacao WHERE excluido IS DISTINCT FROM TRUE"),
], f"""
SELECT 'notificacao' AS tabela_afetada,
       CASE WHEN o.notificacao_id IS NULL THEN 'I' WHEN n.notificacao_id IS NULL THEN 'D' ELSE 'U' END AS operacao,
       CASE WHEN o.notificacao_id IS NOT NULL THEN {_n_img('o')} END AS dados_antigos,
       CASE WHEN n.notificacao_id IS NOT NULL THEN {_n_img('n')} END AS dados_novos
FROM n_old o FULL JOIN n_new n ON o.notificacao_id = n.notificacao_id
WHERE o.notificacao_id IS NULL OR n.notificacao_id IS NULL
   OR o.source_id IS DISTINCT FROM n.source_id OR o.data_notificacao IS DISTINCT FROM n.data_notificacao
   OR o.municipio_notificacao_ibge IS DISTINCT FROM n.municipio_notificacao_ibge
   OR o.estado_notificacao_ibge IS DISTINCT FROM n.estado_notificacao_ibge
   OR o.excluido IS DISTINCT FROM n.excluido OR o.validado IS DISTINCT FROM n.validado""")

CDC_ORACLE = {
    "audit_notificacao": AUDIT_NOTIFICACAO,
    "audit_snapshots": AUDIT_SNAPSHOTS,
    "audit_events_log": AUDIT_EVENTS,
    "audit_stream_events": AUDIT_EVENTS,
    "audit_stream_batches": AUDIT_EVENTS,
}
