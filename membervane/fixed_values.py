"""Labels, lists and constants that results must reproduce exactly."""

# Month abbreviations, January first.
MONTH_TAGS = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")

# Text date formats in the order they are tried.
DATE_FORMATS = ("MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd")

# End period meaning "no end known".
NO_END_PERIOD = 190001

# Transaction codes of members who leave.
LEAVER_CODES = ("D2", "D3")

# Months between scoring and the end of the churn window; months of seniority that count as new.
CHURN_WINDOW_MONTHS = 5
SENIORITY_MONTHS = 12

# Income cap in currency units.
INCOME_CAP = 84.3

# Yearly discount rate and the share of a margin that is promised to the campaign.
DISCOUNT_RATE = 0.1
HAIRCUT = 0.9

# Eligibility bounds of the campaign.
MAX_AGE = 65
VALUE_BOUNDS = (0.0, 1e7)
TOP_CHURN_QUANTILE = 0.8

# Cut fractions of the segment grid: value on the given rows, churn on the full population.
VALUE_FRACTIONS = (0.0, 0.33, 0.66, 1.0)
CHURN_FRACTIONS = (0.8, 0.9, 0.95, 1.0)
CHURN_BAND_NAMES = ("prob_baja", "prob_media", "prob_alta")

# Largest accepted distance between the training and the new score distribution.
DRIFT_ALARM = 0.05

# Half width, in percentile points, of the neighbourhood of a percentile bucket.
DRIFT_TOLERANCE = 2

# Month spans (first, last month back) of the window averages.
AVERAGE_SPANS = {"1to6m": (1, 6), "7to12m": (7, 12), "13to24m": (13, 24)}

# Labels of the five value clusters, numbered from one.
SEGMENT_LABELS = {
    5: "muy alto",
    1: "alto",
    3: "medio",
    2: "bajo",
    4: "muy bajo (alta fuga)",
}

# Plan tiers by preferred provider; a name in two lists belongs to the first. Brand-named plans
# of the deploying insurer are not listed: pass them as extra names.
PLAN_TIERS = {
    "alto": (
        "CLINICA ALEMANA",
        "CLINICA LAS CONDES",
        "LOS ANDES",
        "SAN CARLOS",
        "ALEMANA-SC-LA-CSM / CLC",
        "SAN CARLOS - LOS ANDES",
        "SAN CARLOS - UC - LOS ANDES",
        "BALTICO",
        "SAN CARLOS - STA. MARIA - LOS ANDES",
        "ADRIATICO",
        "SAN CARLOS-UC",
    ),
    "medio": (
        "SANTA MARIA",
        "HOSP. CLINICO UNIVERSIDAD CATOLICA",
        "CLINICA UNIVERSIDAD CATOLICA",
        "TABANCURA",
        "MEDITERRANEO",
        "SAN CARLOS-UC",
        "HOSP.CLINICO UNIVERSIDAD DE CHILE",
        "INDISA INSTITUCIONAL",
        "CLINICA INDISA",
    ),
    "bajo": (
        "DAVILA",
        "BICENTENARIO-VESPUCIO-LAS LILAS",
        "UC SJ 110 - BICENTENARIO - VESPUCIO",
        "CORDILL.-BICENT.-AVANSALUD-SERVET",
        "BICENTENARIO-TABANCURA-DAVILA",
        "BICENTENARIO-VESPUCIO",
        "CLINICA CORDILLERA - CLINICA DAVILA",
        "UC SJ - BICENTENARIO - VESPUCIO",
    ),
    "le": ("LIBRE ELECCION",),
}

# Ordered literal replacements in the preferred-provider name.
PREFERRED_REPLACEMENTS = (
    ("UC ", "UNIVERSIDAD CATOLICA"),
    ("CSM", "STA. MARIA"),
    ("CLC", "CLINICA LAS CONDES"),
    ("BICENT.", "BICENTENARIO"),
    ("CORDILL.", "CLINICA CORDILLERA"),
)

# Text columns whose trailing blanks are removed.
TRIMMED_COLUMNS = (
    "region_gls",
    "sucursal_gls",
    "categor__a_gls",
    "serie",
    "tipo_plan",
    "tipo_producto",
    "actividad",
)

# Columns dropped before the prepared rows are published.
DROPPED_AFTER_PREPARATION = (
    "region_cod",
    "comuna_cod",
    "fecha_nacimiento",
    "cod_sucursal",
    "centrocostos_cod",
    "detalle_producto",
    "cod_categoria",
    "con_comuna_gls",
    "cod_comuna",
    "cod_region",
    "gls_web_region",
    "comuna_gls",
)

# Inputs of the campaign churn model.
CATEGORICAL_INPUTS = (
    "sucursal_gls",
    "region_gls",
    "actividad",
    "tipo_trabajador",
    "tipo_producto",
    "tipo_plan",
    "linea_plan",
    "comuna",
    "sexo",
    "hay_ges_5m",
    "hay_preges_5m",
    "ant_m12_y_ges",
    "norte_centro_sur",
    "preferente",
    "cat_linea_plan",
    "huerfano",
    "gls_isapreant",
    "preexistencia_afi",
    "preexistencia_car",
)
NUMERIC_INPUTS = (
    "antiguedad",
    "edad",
    "costo_final",
    "precio_base",
    "factor_riesgo",
    "costo_total",
    "benef_adic",
    "excesos",
    "excedentes",
    "gasto_ambulatorios",
    "gasto_hospitalarios",
    "gasto_hospitalarios_excl",
    "gasto_ges",
    "gasto_caec",
    "gasto_pharma",
    "recuperacion_gastos",
    "iva_cotizaciones",
    "iva_recuperado",
    "gasto_licencias",
    "gasto_licencias_excl",
    "cie_complejo",
    "prestacion_amb_compleja",
    "gasto_parto",
    "avg_income",
    "pobreza_multi_ptje",
)

# Columns set to zero where negative, in the validated copy only.
ZEROED_COLUMNS = (
    "gasto_licencias_excl",
    "costo_total",
    "factor_riesgo",
    "gasto_licencias_mva_13to24m",
    "gasto_licencias_excl_mva_7to12m",
)

# Columns of the value table that are dropped before scoring, and the one that is renamed.
DROPPED_BEFORE_SCORING = (
    "agencia_vn",
    "agente_vn",
    "clasif_morosidad",
    "clasif_riesgo",
    "costo_final_mva_1to6m",
    "per",
    "periodo_anual",
    "periodo_ult_vig",
    "rut",
    "rut_titular",
)
RENAMED_BEFORE_SCORING = {"benef_adic": "costo_benef_adic"}

# Categorical inputs of the value models.
VALUE_CATEGORICAL_INPUTS = (
    "region_gls",
    "comuna_gls",
    "sucursal_gls",
    "centro_costo_gls",
    "vigente",
    "actividad",
    "tipo_trab",
    "tipo_transac",
    "serie",
    "tipo_plan",
    "tipo_producto",
    "detalle_producto",
    "linea_plan_simplificada",
    "tipo_trabajador",
    "categ_simplificada",
)

# Columns the income, cost and churn models read; the three lists are equal as sets.
VALUE_MODEL_COLUMNS = (
    "comuna_gls",
    "sucursal_gls",
    "actividad",
    "detalle_producto",
    "region_gls",
    "tipo_transac",
    "tipo_trabajador",
    "serie",
    "vigente",
    "tipo_plan",
    "tipo_producto",
    "fechaingreso",
    "antiguedad",
    "num_cargas",
    "edad",
    "num_empleadores",
    "seg_muerte",
    "cambio_plan",
    "costo_final",
    "precio_base",
    "factor_riesgo",
    "costo_total",
    "costo_benef_adic",
    "pagado",
    "excesos",
    "excedentes",
    "gasto_ambulatorios",
    "gasto_hospitalarios",
    "gasto_hospitalarios_excl",
    "gasto_ges",
    "gasto_caec",
    "gasto_pharma",
    "recuperacion_gastos",
    "iva_cotizaciones",
    "iva_recuperado",
    "gasto_licencias",
    "gasto_licencias_excl",
    "cie_complejo",
    "prestacion_amb_compleja",
    "renta_imponible",
    "gasto_parto",
)

# Columns of the campaign deliverables: name in the joined table and name delivered. The segment
# or the eligibility flag follows as the last column.
CAMPAIGN_COLUMNS = {
    "id_titular": "id_titular",
    "sexo": "sexo",
    "edad": "edad",
    "antiguedad": "antiguedad",
    "num_cargas": "num_cargas",
    "comuna": "comuna",
    "region_gls": "region_gls",
    "clasif_riesgo": "clasif_riesgo",
    "clasif_morosidad": "clasif_morosidad",
    "prob_fuga": "prob_fuga",
    "ltv_no_churn_predicted": "ltv_fuga0_predicted",
    "churn_1": "prob_fuga_1y",
    "costo_final": "costo_final",
    "costo_total": "costo_total",
    "predicted_margin_1": "ltv_predicted_1y",
}
