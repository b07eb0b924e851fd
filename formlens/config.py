"""Schemas, aliases and parameters, kept as data.

The first block holds values that must equal the survey form's own
definitions for results to match (header texts, required sets, alias
variants, the raw-to-cleaned mapping, the report catalogue, the fill
value).  They are stated as plain text, in their natural order.

Everything after that block is this engine's own configuration: ASCII
snake_case names for the cleaned columns (labels stay in metadata), the
identifier deny-list used by the safe harmonisation mode, and derived sets.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the form definition; natural order, unchanged)
# ---------------------------------------------------------------------------

FILL_VALUE = "Sin dato"

FUZZY_CUTOFF = 0.60
TOP_K = 10
HIST_MAX_BINS = 10
HIST_MIN_BINS = 5
DATE_OUTPUT_FORMAT = "dd/MM/yyyy"

# The 63 headers of the raw form export, in order.
RAW_COLUMNS = [
    "Marca temporal",
    "Dirección de correo electrónico",
    "¿Acepta el almacenamiento y tratamiento de sus datos personales  de acuerdo con las políticas institucionales?",
    "Fecha de diligenciamiento",
    "¿Cómo te gusta ser llamado/a/e?  (puedes escribir tu nombre identitario o de preferencia, NO necesariamente el nombre legal)",
    "Nombres y apellidos (como aparecen en el documento de identificación)",
    "Tipo de documento de identidad",
    "Número de documento de identidad (Solo el número sin puntos, comas o espacios)",
    "Fecha de nacimiento",
    "Estrato socioeconómico",
    "Ciudad, municipio o corregimiento de nacimiento",
    "Departamento de nacimiento",
    "País de nacimiento",
    "Ciudad, municipio o corregimiento de residencia",
    "Zona de residencia",
    "Dirección de residencia",
    "Barrio de residencia",
    "Comuna a la que pertenece su barrio (si su municipio tiene comunas)",
    "Teléfono fijo o celular",
    "Estado civil",
    "Auto-reconocimiento étnico (Hace referencia al sentido de pertenencia que expresa una persona frente a un colectivo, de acuerdo con su identidad y formas de interactuar en y con el mundo) ",
    "¿A qué grupo poblacional perteneces?",
    "¿Cuáles son tus pronombres?",
    "¿Cuál es tu identidad de géneros? ( es decir, ¿Cómo te vives, sientes, percibes, etc.?)",
    "Expresión de género (¿Cuál es tu apariencia?/¿cómo te muestras al mundo?)",
    "¿Cuál es tu orientación sexual?  es decir,  ¿Quién/es te gusta(n) o  atrae(n)?",
    "¿Has realizado cambio de nombre y/o del componente sexo en tu documento de identidad?",
    'Si la respuesta a la pregunta anterior fue "NO" o sólo cambiaste uno de los dos componentes, ¿Qué te impidió realizar el cambio?',
    "Por favor indícanos si te gustaría recibir orientación para realizar el cambio de nombre y/o sexo en tu documento de identidad.",
    "¿Perteneces a la Universidad del Valle?",
    "Estamento",
    "Sede de la universidad a la que pertenece",
    "Nombre del programa académico",
    "Código de estudiante (escribir sin los dos primeros dígitos EJ: 1424550)",
    "Semestre académico",
    "¿Cuál es tu ocupación actual?",
    "¿Tienes EPS?",
    "¿Cuál es tu EPS?",
    "¿Qué régimen es tu EPS?",
    "Si eres empleado/a/e o independiente ¿A qué te dedicas específicamente?",
    "¿En los últimos 3 meses has recibido alguno de los siguientes tipos de acompañamiento/orientación de acuerdo con tu situación, experiencia o proceso personal en otro espacio, colectivo, organización privada o servicio de salud?",
    "¿En qué tipo de entidad recibiste el acompañamiento?",
    "¿Qué profesional le brindó la atención?",
    "En una escala de 1 a 5, siendo 1 muy desagradable y 5 muy agradable, califica el acompañamiento/orientación que recibiste (si no has recibido ningún tipo de orientación omite esta pregunta)",
    "Por favor cuéntanos por qué elegiste la opción anterior para calificar la experiencia de acompañamiento (opcional)",
    "¿Qué tipo de actividades sueles realizar en tu tiempo libre? ",
    "¿Qué actividades específicas realizas en tu tiempo libre?",
    "¿Cuál(es) es/son tu(s) fuente(s) de ingresos?",
    "¿Con quién(es) vives?",
    "En una escala del  1 al 5, ¿Cómo consideras que es la relación con tu familia?",
    "Por favor indicar nombre de una persona de confianza o representante legal en caso de no poder establecer contacto contigo",
    "Por favor, indícanos el relacionamiento/vínculo que tienes con esta persona referida como de  confianza o representante legal",
    "Por favor indicar el número de contacto (teléfono fijo o celular) del representante legal o la persona de confianza registrada en la pregunta anterior en caso de no poder establecer contacto contigo",
    "Redes de apoyo (Identifica con quiénes o con qué apoyos cuentas)",
    "Factores de riesgo (identifica aquello que puede estar poniéndote en riesgo)",
    "¿Tienes alguna creencia religiosa? ¿Cuál es?",
    'Si respondiste "Si" a la pregunta anterior, ¿Cuál es tu creencia?',
    "Para el encuentro inicial con Campus Diverso ¿te gustaría que tuviera lugar con un(a) profesional de un área específica? Esta opción está sujeta a la disponibilidad de les profesionales.",
    "¿Cómo te enteraste de los servicios de Campus Diverso?",
    "Déjanos, por favor, tus comentarios, sugerencias y observaciones. Para Campus Diverso es muy importante conocer si tienes inquietudes o aportes adicionales.",
    "Unnamed: 60",
    "Unnamed: 61",
    "Convención",
]

# The 34 raw headers a raw export must contain.
MANDATORY_RAW = [
    "Fecha de diligenciamiento",
    "Fecha de nacimiento",
    "Estrato socioeconómico",
    "Ciudad, municipio o corregimiento de nacimiento",
    "Departamento de nacimiento",
    "País de nacimiento",
    "Ciudad, municipio o corregimiento de residencia",
    "Zona de residencia",
    "Barrio de residencia",
    "Estado civil",
    "Auto-reconocimiento étnico (Hace referencia al sentido de pertenencia que expresa una persona frente a un colectivo, de acuerdo con su identidad y formas de interactuar en y con el mundo) ",
    "¿A qué grupo poblacional perteneces?",
    "¿Cuál es tu identidad de géneros? ( es decir, ¿Cómo te vives, sientes, percibes, etc.?)",
    "Expresión de género (¿Cuál es tu apariencia?/¿cómo te muestras al mundo?)",
    "¿Cuál es tu orientación sexual?  es decir,  ¿Quién/es te gusta(n) o  atrae(n)?",
    "¿Has realizado cambio de nombre y/o del componente sexo en tu documento de identidad?",
    'Si la respuesta a la pregunta anterior fue "NO" o sólo cambiaste uno de los dos componentes, ¿Qué te impidió realizar el cambio?',
    "Por favor indícanos si te gustaría recibir orientación para realizar el cambio de nombre y/o sexo en tu documento de identidad.",
    "¿Perteneces a la Universidad del Valle?",
    "Estamento",
    "Sede de la universidad a la que pertenece",
    "Nombre del programa académico",
    "Semestre académico",
    "¿Cuál es tu ocupación actual?",
    "Si eres empleado/a/e o independiente ¿A qué te dedicas específicamente?",
    "¿En los últimos 3 meses has recibido alguno de los siguientes tipos de acompañamiento/orientación de acuerdo con tu situación, experiencia o proceso personal en otro espacio, colectivo, organización privada o servicio de salud?",
    "¿En qué tipo de entidad recibiste el acompañamiento?",
    "¿Qué profesional le brindó la atención?",
    "¿Cuál(es) es/son tu(s) fuente(s) de ingresos?",
    "¿Con quién(es) vives?",
    "Redes de apoyo (Identifica con quiénes o con qué apoyos cuentas)",
    "Factores de riesgo (identifica aquello que puede estar poniéndote en riesgo)",
    "¿Tienes alguna creencia religiosa? ¿Cuál es?",
    "¿Cómo te enteraste de los servicios de Campus Diverso?",
]

# The 35 cleaned columns, in output order.
CLEANED_COLUMNS = [
    "Año de análisis",
    "Fecha de nacimiento",
    "Edad",
    "Estrato socioeconómico",
    "Ciudad, municipio o corregimiento de nacimiento",
    "Departamento de nacimiento",
    "País de nacimiento",
    "Ciudad, municipio o corregimiento de residencia",
    "Zona de residencia",
    "Barrio de residencia",
    "Estado civil",
    "Identidad étnica",
    "Grupo poblacional",
    "Identidad de género",
    "Expresión de género",
    "Orientación sexual",
    "Cambio de nombre/sexo en D.I",
    "Impedimento cambio D.I",
    "Asesoría cambio D.I",
    "Pertenencia a la U",
    "Estamento",
    "Sede de la Universidad del Valle",
    "Nombre del programa académico",
    "Semestre académico",
    "¿Cuál es tu ocupación actual?",
    "Si eres empleado/a/e o independiente ¿A qué te dedicas específicamente?",
    "¿En los últimos 3 meses has recibido alguno de los siguientes tipos de acompañamiento/orientación de acuerdo con tu situación, experiencia o proceso personal en otro espacio, colectivo, organización privada o servicio de salud?",
    "Entidad acompañamiento",
    "Profesional acompañante",
    "¿De donde provienen tus ingresos o recursos?",
    "¿Con quién(es) vives?",
    "Redes de apoyo (Identifica ¿con quiénes/qué apoyos cuentas?)",
    "Factores de riesgo (identifica aquello que puede estar poniéndote en riesgo)",
    "¿Tienes alguna creencia religiosa? ¿Cuál es?",
    "Como te enteraste de Campus Diverso",
]

# Cleaned columns that may be absent in some years.
OPTIONAL_CLEANED = [
    "Fecha de nacimiento",
    "Si eres empleado/a/e o independiente ¿A qué te dedicas específicamente?",
    "¿Tienes alguna creencia religiosa? ¿Cuál es?",
]

# Known header variants per canonical cleaned name.
ALIASES = {
    "Estrato socioeconómico": [
        "Estrato",
    ],
    "Ciudad, municipio o corregimiento de nacimiento": [
        "Ciudad nacimiento",
    ],
    "Departamento de nacimiento": [
        "Departamento",
    ],
    "Ciudad, municipio o corregimiento de residencia": [
        "Ciudad residencia",
    ],
    "Zona de residencia": [
        "Zona residencia",
    ],
    "Barrio de residencia": [
        "Barrio residencia",
    ],
    "Nombre del programa académico": [
        "Nombre y código del programa académico",
    ],
    "¿Cuál es tu ocupación actual?": [
        "Ocupación",
    ],
    "¿En los últimos 3 meses has recibido alguno de los siguientes tipos de acompañamiento/orientación de acuerdo con tu situación, experiencia o proceso personal en otro espacio, colectivo, organización privada o servicio de salud?": [
        "¿Anteriormente, has recibido acompañamiento/orientación de acuerdo con tu situación, experiencia o proceso personal en otro espacio, colectivo, organización privada o servicio de salud?",
    ],
    "Redes de apoyo (Identifica ¿con quiénes/qué apoyos cuentas?)": [
        "Redes de apoyo (Identifica con quiénes o con qué apoyos cuentas)",
        "Redes de apoyo (Identifica con quiénes o con qué apoyos cuentas)",
    ],
    "Como te enteraste de Campus Diverso": [
        "¿Cómo te enteraste de los servicios de Campus Diverso?",
        "Como te enteraste de Campus Diverso",
        "¿Cómo te enteraste de Campus Diverso?",
        "Como te enterasta de Campus Diverso",
    ],
    "Identidad étnica": [
        "Auto-reconocimiento étnico (Hace referencia al sentido de pertenencia que expresa una persona frente a un colectivo, de acuerdo con su identidad y formas de interactuar en y con el mundo) ",
        "Auto-reconocimiento étnico (Hace referencia al sentido de pertenencia que expresa una persona frente a un colectivo, de acuerdo con su identidad y formas de interactuar en y con el mundo)",
        "Identidad étnica",
    ],
    "Grupo poblacional": [
        "¿A qué grupo poblacional perteneces?",
    ],
    "Identidad de género": [
        "¿Cuál es tu identidad de géneros? ( es decir, ¿Cómo te vives, sientes, percibes, etc.?)",
        "¿Cuál es tu identidad de géneros? (es decir, ¿Cómo te vives, sientes, percibes, etc.?)",
    ],
    "Expresión de género": [
        "Expresión de género (¿Cuál es tu apariencia?/¿cómo te muestras al mundo?)",
    ],
    "Orientación sexual": [
        "¿Cuál es tu orientación sexual?  es decir,  ¿Quién/es te gusta(n) o  atrae(n)?",
        "¿Cuál es tu orientación sexual? es decir, ¿Quién/es te gusta(n) o atrae(n)?",
    ],
    "Cambio de nombre/sexo en D.I": [
        "¿Has realizado cambio de nombre y/o del componente sexo en tu documento de identidad?",
    ],
    "Impedimento cambio D.I": [
        'Si la respuesta a la pregunta anterior fue "NO" o sólo cambiaste uno de los dos componentes, ¿Qué te impidió realizar el cambio?',
        "Si la respuesta a la pregunta anterior fue 'NO' o sólo cambiaste uno de los dos componentes, ¿Qué te impidió realizar el cambio?",
    ],
    "Asesoría cambio D.I": [
        "Por favor indícanos si te gustaría recibir orientación para realizar el cambio de nombre y/o sexo en tu documento de identidad.",
    ],
    "Pertenencia a la U": [
        "¿Perteneces a la Universidad del Valle?",
    ],
    "Sede de la Universidad del Valle": [
        "Sede de la universidad a la que pertenece",
    ],
    "Entidad acompañamiento": [
        "¿En qué tipo de entidad recibiste el acompañamiento?",
    ],
    "Profesional acompañante": [
        "¿Qué profesional le brindó la atención?",
    ],
    "¿De donde provienen tus ingresos o recursos?": [
        "¿Cuál(es) es/son tu(s) fuente(s) de ingresos?",
    ],
}

# Raw header -> cleaned column (33 pairs).
RAW_TO_CLEANED = {
    "Fecha de nacimiento": "Fecha de nacimiento",
    "Estrato socioeconómico": "Estrato socioeconómico",
    "Ciudad, municipio o corregimiento de nacimiento": "Ciudad, municipio o corregimiento de nacimiento",
    "Departamento de nacimiento": "Departamento de nacimiento",
    "País de nacimiento": "País de nacimiento",
    "Ciudad, municipio o corregimiento de residencia": "Ciudad, municipio o corregimiento de residencia",
    "Zona de residencia": "Zona de residencia",
    "Barrio de residencia": "Barrio de residencia",
    "Estado civil": "Estado civil",
    "Auto-reconocimiento étnico (Hace referencia al sentido de pertenencia que expresa una persona frente a un colectivo, de acuerdo con su identidad y formas de interactuar en y con el mundo) ": "Identidad étnica",
    "¿A qué grupo poblacional perteneces?": "Grupo poblacional",
    "¿Cuál es tu identidad de géneros? ( es decir, ¿Cómo te vives, sientes, percibes, etc.?)": "Identidad de género",
    "Expresión de género (¿Cuál es tu apariencia?/¿cómo te muestras al mundo?)": "Expresión de género",
    "¿Cuál es tu orientación sexual?  es decir,  ¿Quién/es te gusta(n) o  atrae(n)?": "Orientación sexual",
    "¿Has realizado cambio de nombre y/o del componente sexo en tu documento de identidad?": "Cambio de nombre/sexo en D.I",
    'Si la respuesta a la pregunta anterior fue "NO" o sólo cambiaste uno de los dos componentes, ¿Qué te impidió realizar el cambio?': "Impedimento cambio D.I",
    "Por favor indícanos si te gustaría recibir orientación para realizar el cambio de nombre y/o sexo en tu documento de identidad.": "Asesoría cambio D.I",
    "¿Perteneces a la Universidad del Valle?": "Pertenencia a la U",
    "Estamento": "Estamento",
    "Sede de la universidad a la que pertenece": "Sede de la Universidad del Valle",
    "Nombre del programa académico": "Nombre del programa académico",
    "Semestre académico": "Semestre académico",
    "¿Cuál es tu ocupación actual?": "¿Cuál es tu ocupación actual?",
    "Si eres empleado/a/e o independiente ¿A qué te dedicas específicamente?": "Si eres empleado/a/e o independiente ¿A qué te dedicas específicamente?",
    "¿En los últimos 3 meses has recibido alguno de los siguientes tipos de acompañamiento/orientación de acuerdo con tu situación, experiencia o proceso personal en otro espacio, colectivo, organización privada o servicio de salud?": "¿En los últimos 3 meses has recibido alguno de los siguientes tipos de acompañamiento/orientación de acuerdo con tu situación, experiencia o proceso personal en otro espacio, colectivo, organización privada o servicio de salud?",
    "¿En qué tipo de entidad recibiste el acompañamiento?": "Entidad acompañamiento",
    "¿Qué profesional le brindó la atención?": "Profesional acompañante",
    "¿Cuál(es) es/son tu(s) fuente(s) de ingresos?": "¿De donde provienen tus ingresos o recursos?",
    "¿Con quién(es) vives?": "¿Con quién(es) vives?",
    "Redes de apoyo (Identifica con quiénes o con qué apoyos cuentas)": "Redes de apoyo (Identifica ¿con quiénes/qué apoyos cuentas?)",
    "Factores de riesgo (identifica aquello que puede estar poniéndote en riesgo)": "Factores de riesgo (identifica aquello que puede estar poniéndote en riesgo)",
    "¿Tienes alguna creencia religiosa? ¿Cuál es?": "¿Tienes alguna creencia religiosa? ¿Cuál es?",
    "¿Cómo te enteraste de los servicios de Campus Diverso?": "Como te enteraste de Campus Diverso",
}

# Headers that only a raw export has.
RAW_MARKERS = [
    "Marca temporal",
    "Dirección de correo electrónico",
]

# Report keys, in their default order.
REPORT_KEYS = [
    "identidad_genero",
    "orientacion_sexual",
    "estamento",
    "sede",
    "estrato",
    "edad",
]

# Categorical report key -> cleaned column.
REPORT_CATALOGUE = {
    "identidad_genero": "Identidad de género",
    "orientacion_sexual": "Orientación sexual",
    "estamento": "Estamento",
    "sede": "Sede de la Universidad del Valle",
    "estrato": "Estrato socioeconómico",
}

# Quality-summary indicator labels; {base} is the input label below.
QUALITY_LABELS = [
    "Filas en {base}",
    "Columnas en {base}",
    "Filas en base cleaned final",
    "Columnas en base cleaned final",
    "Registros con fecha de nacimiento válida",
    "Registros con edad calculada o válida",
]
QUALITY_BASE_RAW = "base raw filtrada"
QUALITY_BASE_CLEANED = "base cleaned cargada"

# Special column labels used by the row operators.
YEAR_LABEL = "Año de análisis"
BIRTH_LABEL = "Fecha de nacimiento"
AGE_LABEL = "Edad"
SEMESTER_LABEL = "Semestre académico"
SUBMITTED_LABEL = "Marca temporal"
FILLED_LABEL = "Fecha de diligenciamiento"

# ---------------------------------------------------------------------------
# Engine configuration (own choices)
# ---------------------------------------------------------------------------

# Internal ASCII names for the 35 cleaned columns, same order as the labels.
CLEANED_NAMES = [
    "analysis_year",
    "birth_date",
    "age",
    "stratum",
    "birth_city",
    "birth_department",
    "birth_country",
    "residence_city",
    "residence_zone",
    "neighbourhood",
    "marital_status",
    "ethnic_identity",
    "population_group",
    "gender_identity",
    "gender_expression",
    "sexual_orientation",
    "id_change",
    "id_change_obstacle",
    "id_change_advice",
    "university_member",
    "estate",
    "campus",
    "programme",
    "semester",
    "occupation",
    "employment_detail",
    "prior_support",
    "support_entity",
    "support_professional",
    "income_source",
    "lives_with",
    "support_network",
    "risk_factors",
    "religion",
    "heard_about",
]

LABEL_TO_NAME = dict(zip(CLEANED_COLUMNS, CLEANED_NAMES))
NAME_TO_LABEL = dict(zip(CLEANED_NAMES, CLEANED_COLUMNS))

OPTIONAL_NAMES = [LABEL_TO_NAME[c] for c in OPTIONAL_CLEANED]
MINIMUM_CLEANED = [c for c in CLEANED_COLUMNS if c != YEAR_LABEL and c not in OPTIONAL_CLEANED]

# Cleaned columns that are not free text.
TYPED_NAMES = ["analysis_year", "birth_date", "age", "semester"]
TEXT_NAMES = [n for n in CLEANED_NAMES if n not in ("analysis_year", "birth_date", "age")]

# Raw headers that identify a person directly.  The safe harmonisation
# mode never lets one of them be renamed (fuzzy) into a cleaned column.
IDENTIFIER_RAW = [
    "Dirección de correo electrónico",
    "¿Cómo te gusta ser llamado/a/e?  (puedes escribir tu nombre identitario o de preferencia, NO necesariamente el nombre legal)",
    "Nombres y apellidos (como aparecen en el documento de identificación)",
    "Número de documento de identidad (Solo el número sin puntos, comas o espacios)",
    "Tipo de documento de identidad",
    "Dirección de residencia",
    "Teléfono fijo o celular",
    "Código de estudiante (escribir sin los dos primeros dígitos EJ: 1424550)",
    "Por favor indicar nombre de una persona de confianza o representante legal en caso de no poder establecer contacto contigo",
    "Por favor, indícanos el relacionamiento/vínculo que tienes con esta persona referida como de  confianza o representante legal",
    "Por favor indicar el número de contacto (teléfono fijo o celular) del representante legal o la persona de confianza registrada en la pregunta anterior en caso de no poder establecer contacto contigo",
]

# Schema name -> expected header list, for the conformance report.
EXPECTED_SCHEMAS = {
    "raw": RAW_COLUMNS,
    "cleaned_min": MINIMUM_CLEANED,
}
