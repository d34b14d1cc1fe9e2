"""Word lists, vocabularies and patterns that decide results."""

# ---- Fixed values: results are only right when these stay exactly as they are. ----

# Columns of a raw listing that the feature step needs, in order.
LISTING_COLUMNS = [
    "shipping", "non_mercado_pago_payment_methods", "price", "variations", "listing_type_id",
    "buying_mode", "tags", "official_store_id", "automatic_relist", "initial_quantity",
    "condition", "warranty_category", "sold_quantity", "seller_address", "title",
]
LABEL_CODES = {"new": 0, "used": 1}
PAYMENT_NAMES = [
    "Visa Electron", "Mastercard Maestro", "Acordar con el comprador", "Transferencia bancaria",
    "Visa", "Contra reembolso", "MasterCard", "Cheque certificado", "Tarjeta de crédito",
    "Giro postal", "Diners", "Efectivo", "American Express", "MercadoPago",
]
LISTING_TYPES = ["bronze", "silver", "free", "gold_special", "gold", "gold_premium", "gold_pro"]
BUYING_MODES = ["buy_it_now", "classified", "auction"]
TAG_NAMES = [
    "dragged_bids_and_visits", "good_quality_thumbnail", "dragged_visits", "free_relist",
    "poor_quality_thumbnail",
]
SHIPPING_MODES = ["custom", "not_specified", "me1", "me2"]
NO_WARRANTY_LABELS = [
    "Sin garantía", "Garantía de autenticidad / descripción",
    "Garantía basada en reputación del vendedor",
]
TOP_STATES = ["Capital Federal", "Buenos Aires", "Santa Fe", "Córdoba", "Mendoza"]
OTHER_STATE = "Otros"
WARRANTY_LABELS = [
    "Garantía oficial del fabricante / importador", "Garantía por defecto de fabricación",
    "Garantía con plazo explícito", "Garantía ilimitada / de por vida",
    "Garantía de satisfacción / devolución de dinero",
    "Garantía basada en reputación del vendedor", "Garantía de autenticidad / descripción",
    "Garantía de inspección en el punto de entrega", "Sin garantía",
]
UNKNOWN_REPLY = "desconocido"

# Title profiling.
NUMERIC_PATTERNS = {
    "years": r"\b(19|20)\d{2}\b",
    "specifications_gb": r"\b\d+\s*gb\b",
    "specifications_mb": r"\b\d+\s*mb\b",
    "specifications_mpx": r"\b\d+\s*mpx\b",
    "specifications_core": r"\b(core\s*i\d|i\d)\b",
    "specifications_ram": r"\b\d+\s*ram\b",
    "numeric_models": r"\b\d{3,4}\b",
    "versions": r"\bv\d+\b",
    "dimensions": r"\b\d+\s*(inches|\"|'')?\b",
}
SPECIAL_PATTERNS = {
    "exclamation_marks": r"!+",
    "uppercase_words": r"\b[A-Z]{3,}\b",
    "numbers_parentheses": r"\([^)]*\d[^)]*\)",
    "multiple_hyphens": r"-{2,}",
    "peso_prices": r"\$\d+",
    "measurements": r"\b\d+\s*(cm|mm|m|inches|\")\b",
    "colors": r"\b(negro|blanco|azul|rojo|verde|amarillo|gris|rosa|violeta)\b",
    "conditions": r"\b(nuevo|usado|seminuevo|impecable|excelente|bueno|regular)\b",
    "urgency": r"\b(urgente|liquido|oferta|ganga|oportunidad)\b",
}
REPORT_PATTERNS = {
    "years": r"\b(19|20)\d{2}\b",
    "specifications_gb": r"\b\d+\s*gb\b",
    "specifications_core": r"\b(core\s*i\d|i\d)\b",
    "numeric_models": r"\b\d{3,4}\b",
    "uppercase_words": r"\b[A-Z]{3,}\b",
    "urgency": r"\b(urgente|liquido|oferta|ganga)\b",
}
PROFILE_CATEGORIES = {
    "electronics": ["celular", "smartphone", "notebook", "laptop", "tablet", "tv", "televisor",
                    "monitor", "auriculares", "parlante", "camara", "iphone", "samsung", "display"],
    "automotive": ["auto", "carro", "vehiculo", "motor", "llanta", "amortiguador", "filtro",
                   "aceite", "freno", "bateria", "repuesto", "ford", "chevrolet", "toyota"],
    "books": ["libro", "enciclopedia", "manual", "guia", "diccionario", "atlas", "historia",
              "novela", "biografia", "ensayo", "literatura", "editorial"],
    "clothing": ["zapatillas", "zapatos", "remera", "pantalon", "jean", "camisa", "vestido",
                 "buzo", "campera", "nike", "adidas", "talle", "ropa"],
    "home": ["mesa", "silla", "cama", "sofa", "armario", "espejo", "lampara", "decoracion",
             "cocina", "baño", "jardin", "mueble", "fundas", "almohada"],
    "toys": ["juguete", "muneca", "pelota", "puzzle", "rompecabezas", "lego", "barbie",
             "disney", "juego", "infantil", "niño", "niña"],
    "sports": ["bicicleta", "pelota", "futbol", "tenis", "gym", "fitness", "deportivo",
               "ejercicio", "running", "natacion"],
    "music": ["guitarra", "piano", "violin", "bateria", "microfono", "amplificador",
              "instrumento", "musical", "fender", "yamaha"],
}

# Title features.
WORDS_NEW = [
    "amortiguador", "fric", "imprimible", "embrague", "llanta", "espiral", "delantero",
    "delanteros", "pastilla", "ventilado", "nuevo", "original", "kit", "digital", "para", "con",
    "oferta",
]
WORDS_USED = [
    "usado", "usada", "usados", "poco", "buen", "estado", "funcionando", "antiguo", "antigua",
    "vinilo", "revista", "lote", "excelente", "impecable", "año", "historia", "argentina",
]
TITLE_CATEGORIES = {
    "automotriz": ["auto", "carro", "vehiculo", "motor", "amortiguador", "freno", "filtro",
                   "aceite", "llanta", "bateria", "ford", "fiat", "renault", "chevrolet",
                   "toyota", "peugeot", "volkswagen", "repuesto"],
    "electronico": ["celular", "smartphone", "notebook", "laptop", "tablet", "tv", "televisor",
                    "monitor", "auriculares", "samsung", "iphone", "sony", "lg", "display",
                    "digital", "cable", "memoria", "disco"],
    "musica": ["guitarra", "piano", "violin", "bateria", "microfono", "amplificador",
               "instrumento", "musical", "cd", "vinilo", "disco", "album"],
    "hogar": ["mesa", "silla", "cama", "sofa", "armario", "espejo", "lampara", "decoracion",
              "cocina", "baño", "mueble", "fundas", "almohada", "sabanas", "cortinas"],
    "libro": ["libro", "enciclopedia", "manual", "guia", "diccionario", "atlas", "historia",
              "novela", "biografia", "literatura", "revista", "comic"],
    "ropa": ["zapatillas", "zapatos", "remera", "pantalon", "jean", "camisa", "vestido", "buzo",
             "campera", "talle", "nike", "adidas", "ropa"],
    "juguete": ["juguete", "muneca", "pelota", "puzzle", "rompecabezas", "lego", "barbie",
                "disney", "juego", "infantil", "niño", "niña"],
    "deporte": ["bicicleta", "pelota", "futbol", "tenis", "gym", "fitness", "deportivo",
                "ejercicio", "running", "natacion"],
}
CATEGORY_SHARE_NEW = {
    "automotriz": 0.786, "electronico": 0.615, "musica": 0.754, "hogar": 0.609,
    "libro": 0.340, "ropa": 0.525, "juguete": 0.587, "deporte": 0.544,
}
BRANDS = [
    "samsung", "original", "kit", "digital", "argentina", "cuero", "ford", "fiat", "renault",
    "sony", "lg", "nike", "adidas", "apple", "iphone",
]
SIGNS_NEW = ["nuevo", "original", "sellado", "garantia", "estrenar"]
SIGNS_USED = ["usado", "usada", "estado", "funcionando", "poco", "buen"]
FULL_YEARS = r"\b(19[5-9]\d|20[0-2]\d)\b"
BARE_CENTURY = r"\b(19|20)\b"
SPEC_GB = r"\b\d+\s*gb\b"
SPEC_MB = r"\b\d+\s*mb\b"
SPEC_CORE = r"\b(core\s*i\d|i[3-9])\b"
NUMERIC_MODELS = r"\b\d{3,4}\b"
VERSIONS = r"\bv\d+\b"
DIMENSIONS = r"\b\d+\s*(cm|mm|m|pulgadas|\")\b"
CAPITAL_WORDS = r"\b[A-Z]{2,}\b"
URGENCY = r"\b(urgente|liquido|oferta|ganga|oportunidad)\b"
STATED_CONDITION = r"\b(nuevo|usado|seminuevo|impecable|excelente)\b"
PRICES = r"\$\d+"
COLORS = r"\b(negro|blanco|azul|rojo|verde|amarillo|gris|rosa|violeta)\b"
REFERENCE_YEAR = 2024
SAMPLE_TITLES = [
    "Amortiguador Delantero Ford Focus 2015 Original Nuevo",
    "Libro Historia Argentina Antiguo 1967 Excelente Estado",
    "Samsung Galaxy S21 256GB Nuevo Sellado Garantía",
    "Vinilo Los Beatles Revolver 1966 Usado Buen Estado",
    "Kit Embrague Fiat Palio 2020 Original Para Mecánico",
]
# ---- End of fixed values. ----

# Keyword rules standing in for a zero-shot model; our own choice, freely replaceable.
WARRANTY_WORDS = {
    WARRANTY_LABELS[0]: ["fabricante", "importador", "oficial", "fabrica"],
    WARRANTY_LABELS[1]: ["defecto", "falla", "fabricacion", "fabricación"],
    WARRANTY_LABELS[2]: ["mes", "año", "dias", "días", "semana", "hora"],
    WARRANTY_LABELS[3]: ["por vida", "ilimitada", "siempre", "permanente"],
    WARRANTY_LABELS[4]: ["devoluc", "dinero", "satisf", "reintegro"],
    WARRANTY_LABELS[5]: ["reputac", "calificac", "confianza", "vendedor"],
    WARRANTY_LABELS[6]: ["autentic", "descri", "foto", "original"],
    WARRANTY_LABELS[7]: ["prueba", "inspec", "revis", "al retirar"],
    WARRANTY_LABELS[8]: ["sin garant", "no tiene", "no posee", "ninguna"],
}
TITLE_PROMPT = (
    "Título: \"{title}\". Condición: \"{condition}\". Responde solo con un objeto JSON con las claves "
    "keywords, category, brand, product_type, condition_detail y potential_patterns; "
    "usa \"desconocido\" cuando falte un dato."
)
