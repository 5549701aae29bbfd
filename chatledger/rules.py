"""Business rules of the case analysis, as plain configuration.

Every operator takes a ``Rules`` value; ``DEFAULT_RULES`` holds the standard
word lists and limits. Other lists can be passed without touching the code.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: these lists and limits define the results, so they must not change. ---

SALES_TERMS = (
    "precio", "pollo", "muslo", "pechuga", "alas", "carne",
    # one term, not two: neither "corte" nor "domicilio" counts alone
    "cortedomicilio",
    "efectivo", "debito", "débito", "credito", "crédito", "pedido", "pago",
    "factura", "entrega", "compra", "venta", "valor", "kilo", "combo", "promo",
    "costo", "cuanto", "cuánto", "transferencia", "nequi", "daviplata",
    "sucursal", "despacho", "porfavor", "gracias", "libra",
)

COLLEAGUE_TERMS = (
    "parce", "parcero", "mijo", "jefe", "mantenimiento", "almuerzo", "reunion",
    "reunión", "compañero", "compañera", "turno", "descanso", "nomina", "nómina",
    "permiso", "incapacidad", "vacaciones", "granja",
)

GREETINGS = (
    "hola", "holaa", "buenas", "buen dia", "buen día", "buenos dias",
    "buenos días", "buenas tardes", "buenas noches", "gracias",
    "muchas gracias", "ok", "okey", "vale", "listo", "si", "sí", "no",
    "de acuerdo", "hello", "hi", "bueno",
)

NON_SUBSTANTIVE_PHRASES = (
    "encuesta", "calific", "puntu", "del 1 al", "satisfacc", "recomendar",
    "su opinion", "su opinión", "gracias por", "muy amable",
    "excelente servicio", "buen servicio", "feliz dia", "feliz día",
    "bendiciones",
)

MEDIA_EXTENSIONS = (
    ".jpg", ".jpeg", ".png", ".gif", ".webp", ".mp3", ".ogg", ".opus", ".aac",
    ".m4a", ".mp4", ".mov", ".3gp", ".pdf",
)

MEDIA_WORDS = (
    "audio", "imagen", "video", "sticker", "foto", "archivo adjunto",
    "adjunto", "ptt", "media", "documento",
)

OMITTED_MEDIA = "omitid"
CALL_MARKERS = ("llamada saliente", "llamada entrante")
SYSTEM_DOMAIN = "@SAGICC.CO"
SYSTEM_PREFIX = "SAGICC"
TRIVIAL_STRIP = "¡!¿?.,;:()\"'* "
MEDIA_STRIP = "[]<>() "

LONG_CASE_MESSAGES = 30
MAX_GAP_HOURS = 24
TRIVIAL_LENGTH = 3

# category -> audit section, in the order in which sections are reported
SECTIONS = {
    "duplicados": "casos_duplicados",
    "llamada": "casos_llamadas",
    "con_llamada": "casos_con_llamada",
    "solo_inbound": "casos_solo_inbound",
    "solo_outbound": "casos_solo_outbound",
    "mensaje_repetido": "casos_mensaje_repetido",
    "fechas_incoherentes": "casos_fechas_incoherentes",
    "colaborador": "casos_colaborador",
    "sin_atencion_humana": "casos_sin_atencion_humana",
    "sin_bot": "casos_sin_bot",
    "extraordinario": "casos_extraordinarios",
    "sin_palabras_venta": "casos_sin_palabras_venta",
    "vacio": "casos_vacios",
}

DESCRIPTIONS = {
    "casos_duplicados": "Casos con mensajes sustantivos duplicados. Los registros repetidos se eliminaron; saludos repetidos no marcan esta categoría.",
    "casos_llamadas": "Casos atendidos por LLAMADA: el chat solo no forma conversación. Excluidos.",
    "casos_con_llamada": "Casos con marcador de llamada PERO con chat completo. Sí se calcularon.",
    "casos_solo_inbound": "2+ mensajes, todos del cliente, sin respuesta registrada. Excluidos. (Los de un solo mensaje se descartan sin marcar.)",
    "casos_solo_outbound": "2+ mensajes, todos salientes; el cliente nunca escribió. Excluidos. (Los de un solo mensaje se descartan sin marcar.)",
    "casos_mensaje_repetido": "El cliente envió 2+ veces exactamente el mismo mensaje y nada más: no es conversación. Excluidos.",
    "casos_fechas_incoherentes": "Un mismo nro_caso con conversaciones separadas por un hueco > 24h (fechas que no cuadran). Excluidos.",
    "casos_colaborador": "Sin palabras de venta y con vocabulario coloquial/interno: posible charla entre colaboradores. Excluidos.",
    "casos_sin_atencion_humana": "Conversaciones SIN respuesta de agente humano posterior al cliente. Excluidos.",
    "casos_sin_bot": "Conversaciones atendidas por humano SIN paso previo de bot. Sí se calcularon (incluidas en métricas); se listan aparte.",
    "casos_extraordinarios": "Casos con más de 30 mensajes (conversación inusualmente larga). Sí se calcularon; revisar.",
    "casos_sin_palabras_venta": "Conversación sin vocabulario de venta (posible charla interna). Sí se calcularon.",
    "casos_vacios": "Sin mensajes válidos tras la limpieza. Excluidos.",
}

# sections of cases nobody attended; an earlier one wins over a later one
NOT_ATTENDED_SECTIONS = (
    "casos_sin_atencion_humana",
    "casos_solo_inbound",
    "casos_mensaje_repetido",
)

# upper bound in minutes (inclusive) -> value; None is "everything above"
SCORE_BANDS = ((2, 100), (5, 80), (10, 50), (None, 20))
RESPONSE_BANDS = ((1, "0 a 1"), (5, "1 a 5"), (10, "5 a 10"), (None, "> 10"))
PACE_BANDS = (
    (2, "Conversación verbal (0-2 min)"),
    (5, "Fluida (3-5 min)"),
    (10, "Riesgo comercial (6-10 min)"),
    (None, "Conversación fría (>10 min)"),
)

NO_CAMPAIGN = "(sin campaña)"
NO_CHANNEL = "(sin canal)"
NO_AGENT = "(sin agente)"

# --- End of the fixed values. ---


@dataclass(frozen=True)
class Rules:
    sales_terms: tuple[str, ...] = SALES_TERMS
    colleague_terms: tuple[str, ...] = COLLEAGUE_TERMS
    greetings: tuple[str, ...] = GREETINGS
    non_substantive: tuple[str, ...] = NON_SUBSTANTIVE_PHRASES
    media_extensions: tuple[str, ...] = MEDIA_EXTENSIONS
    media_words: tuple[str, ...] = MEDIA_WORDS
    call_markers: tuple[str, ...] = CALL_MARKERS
    system_domain: str = SYSTEM_DOMAIN
    system_prefix: str = SYSTEM_PREFIX
    long_case_messages: int = LONG_CASE_MESSAGES
    max_gap_hours: int = MAX_GAP_HOURS

    def __post_init__(self) -> None:
        if self.max_gap_hours < 1:  # gaps are compared between hours, so shorter limits cannot be exact
            raise ValueError("max_gap_hours must be at least 1")


DEFAULT_RULES = Rules()
