"""Names, aliases, formats and thresholds that results depend on."""

# --- fixed values: canonical price table -------------------------------------------------------------------
PRICE_COLUMNS = {
    "state": "string", "district": "string", "district_raw": "string", "market": "string",
    "commodity": "string", "variety": "string", "grade": "string", "arrival_date": "date",
    "min_price": "double", "max_price": "double", "modal_price": "double", "commodity_code": "double",
    "source": "string", "ingested_at_utc": "timestamp_ntz",
}
PRICE_REQUIRED = ["state", "district", "market", "commodity", "arrival_date"]
PRICE_KEY = ["state", "district", "market", "commodity", "variety", "grade", "arrival_date"]
PRICE_MEASURES = ["min_price", "max_price", "modal_price"]
SOURCE_RANK = {"current": 2, "history": 1}

# --- fixed values: canonical weather tables ----------------------------------------------------------------
WEATHER_COLUMNS = {
    "date": "date", "district": "string", "latitude": "double", "longitude": "double",
    "t2m_max": "double", "t2m_min": "double", "t2m_mean": "double", "rh2m": "double",
    "precipitation": "double", "ws2m": "double", "srad": "double", "source": "string",
}
FORECAST_COLUMNS = {
    "date": "date", "district": "string", "latitude": "double", "longitude": "double",
    "temperature_max": "double", "temperature_min": "double", "precipitation_sum": "double",
    "windspeed_max": "double", "precipitation_probability_max": "double", "weathercode": "double",
    "source": "string",
}
WEATHER_KEY = ["date", "district"]
WEATHER_MEASURES = ["t2m_max", "t2m_min", "t2m_mean", "rh2m", "precipitation", "ws2m", "srad"]
JOINED_WEATHER = {
    "t2m_max": "t2m_max", "t2m_min": "t2m_min", "t2m_mean": "t2m_mean", "rh2m": "humidity",
    "precipitation": "precipitation", "ws2m": "wind_speed", "srad": "solar_radiation",
}

# --- fixed values: column names seen in sources, canonical name -> accepted snake_case names --------------
PRICE_ALIASES = {
    "state": ["state", "state_name", "statename"],
    "district": ["district", "district_name", "districtname", "dist"],
    "market": ["market", "market_name", "marketname", "mandi", "mandi_name"],
    "commodity": ["commodity", "commodity_name", "commodityname", "crop"],
    "variety": ["variety", "variety_name", "varietyname"],
    "grade": ["grade", "grade_name", "gradename", "quality"],
    "arrival_date": ["arrival_date", "arrivaldate", "date", "price_date", "pricedate", "reported_date"],
    "min_price": ["min_price", "minprice", "minimum_price", "min"],
    "max_price": ["max_price", "maxprice", "maximum_price", "max"],
    "modal_price": ["modal_price", "modalprice", "mode_price", "modal", "mod_price"],
    "commodity_code": ["commodity_code", "commoditycode", "comm_code", "code"],
}
RAW_PRICE_ALIASES = {
    "state": ["state", "state_name"],
    "district": ["district", "district_name"],
    "market": ["market", "market_name", "mandi"],
    "commodity": ["commodity", "commodity_name"],
    "variety": ["variety", "variety_name"],
    "grade": ["grade"],
    "arrival_date": ["arrival_date", "date", "arrival_dt", "reported_date", "price_date"],
    "min_price": ["min_price", "minimum_price", "price_min"],
    "max_price": ["max_price", "maximum_price", "price_max"],
    "modal_price": ["modal_price", "mode_price", "avg_price", "price"],
}
WEATHER_ALIASES = {
    "date": ["date"],
    "district": ["district"],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lon"],
    "t2m_max": ["t2m_max", "temperature_max"],
    "t2m_min": ["t2m_min", "temperature_min"],
    "t2m_mean": ["t2m", "temperature_mean"],
    "rh2m": ["rh2m", "relative_humidity"],
    "precipitation": ["prectotcorr", "prectot", "precipitation", "precip"],
    "ws2m": ["ws2m", "wind_speed", "windspeed"],
    "srad": ["allsky_sfc_sw_dwn", "srad", "solar_radiation"],
}
FORECAST_ALIASES = {
    "date": ["date"],
    "district": ["district"],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lon"],
    "temperature_max": ["temperature_2m_max", "temperature_max", "temp_max"],
    "temperature_min": ["temperature_2m_min", "temperature_min", "temp_min"],
    "precipitation_sum": ["precipitation_sum", "precip_sum", "total_precipitation"],
    "windspeed_max": ["windspeed_10m_max", "windspeed_max", "wind_speed_max"],
    "precipitation_probability_max": ["precipitation_probability_max", "precip_prob_max"],
    "weathercode": ["weathercode", "weather_code"],
}

# --- fixed values: date formats in the order they are tried -----------------------------------------------
PRICE_DATE_FORMATS = [
    "yyyy-M-d", "d-M-yyyy", "d/M/yyyy", "yyyy/M/d", "d-MMM-yyyy", "d MMM yyyy",
    "yyyy-M-d H:m:s", "d-M-yyyy H:m:s",
]
RAW_DATE_FORMATS = [
    "d/M/yyyy", "yyyy-M-d", "d-M-yyyy", "yyyy/M/d", "d MMM yyyy", "d-MMM-yyyy", "d MMMM yyyy", "yyyyMMdd",
]
WEATHER_DATE_FORMATS = ["yyyy-M-d", "yyyyMMdd", "d-M-yyyy", "d/M/yyyy", "yyyy/M/d"]

# --- fixed values: districts, grouped by division ----------------------------------------------------------
DIVISIONS = {
    "Konkan": ["Mumbai City", "Mumbai Suburban", "Thane", "Palghar", "Raigad", "Ratnagiri", "Sindhudurg"],
    "Pune": ["Pune", "Satara", "Sangli", "Solapur", "Kolhapur"],
    "Nashik": ["Nashik", "Ahmednagar", "Dhule", "Nandurbar", "Jalgaon"],
    "Aurangabad": ["Aurangabad", "Jalna", "Beed", "Parbhani", "Hingoli", "Latur", "Osmanabad", "Nanded"],
    "Amravati": ["Amravati", "Akola", "Buldhana", "Washim", "Yavatmal"],
    "Nagpur": ["Nagpur", "Wardha", "Bhandara", "Gondia", "Chandrapur", "Gadchiroli"],
}
DISTRICTS = sorted(name for members in DIVISIONS.values() for name in members)

# --- fixed values: spellings of district names beyond the lower-cased canonical name ----------------------
DISTRICT_VARIANTS = {
    "Amravati": ["amarawati", "amrawati"],
    "Aurangabad": ["chattrapati sambhajinagar", "chhatrapati sambhajinagar", "sambhajinagar",
                   "chh. sambhajinagar"],
    "Beed": ["bid"],
    "Buldhana": ["buldana"],
    "Chandrapur": ["chandrapura"],
    "Gadchiroli": ["gadchiroli."],
    "Gondia": ["gondiya", "gondya"],
    "Hingoli": ["hingholi"],
    "Jalna": ["jalana"],
    "Kolhapur": ["kolhapura"],
    "Mumbai City": ["mumbai"],
    "Mumbai Suburban": ["greater mumbai", "mumbai (suburban)"],
    "Nanded": ["nanded-waghala"],
    "Nashik": ["nasik"],
    "Osmanabad": ["dharashiv", "dharashiv (usmanabad)", "dharashiv(usmanabad)", "usmanabad", "murum"],
    "Parbhani": ["parbani"],
    "Raigad": ["raigarh", "alibag"],
    "Sindhudurg": ["sindhdurg", "sindhudurga"],
    "Solapur": ["sholapur", "sholapur."],
    "Washim": ["vashim"],
    "Yavatmal": ["yeotmal", "yavtmal"],
}

# --- fixed values: names of request fields that must not be stored ----------------------------------------
SENSITIVE_FIELDS = ["api_key", "apikey", "key", "token", "secret", "password", "auth"]

# --- fixed values: feature windows, horizons and decision thresholds --------------------------------------
LAGS = [1, 2, 3, 7, 14, 21, 30]
ROLLING = [3, 7, 14, 30]
MOMENTUM = [7, 14, 30]
VOLATILITY = [7, 14]
CHANGES = [1, 7]
HORIZONS = [1, 3, 7, 14, 15]
MIN_SERIES_ROWS = 31
GAIN_THRESHOLD_PCT = 5.0
COST_PER_KM = 2.0
DEFAULT_DISTANCE_KM = 50.0
CONFIDENCE_NUMBER = {"high": 93.3, "medium": 86.0}
CONFIDENCE_OTHER = 78.0
TREND_BAND = 0.02

# --- fixed values: crop risk -------------------------------------------------------------------------------
SEVERITY_WEIGHT = {"low": 0.25, "medium": 0.5, "high": 1.0}
RISK_LABEL = {0: "Low", 1: "Medium", 2: "High"}
CLASS_WEIGHT = {0: 1.0, 1: 10.0, 2: 50.0}
WEATHER_STATS = [
    "rainfall_3d", "rainfall_7d", "rainfall_14d", "rainfall_max_day", "rainfall_days_7d",
    "temp_max", "temp_min", "temp_mean", "temp_range", "temp_std", "humidity", "humidity_max",
    "hot_days_7d", "cold_days_7d", "wet_days_7d", "gdd_7d", "gdd_14d", "vpd_7d", "drought_stress_7d",
]
# Names under which forecasts bring their measures, in the order in which they are looked for.
FORECAST_NAMES = {
    "precipitation": ["prcp", "rain"], "t2m_max": ["temp_max", "tmax"], "t2m_min": ["temp_min", "tmin"],
    "t2m_mean": ["temp_mean", "tmean"], "rh2m": ["humidity", "rh"],
}
STAT_DEFAULTS = {
    "rainfall_3d": 0.0, "rainfall_7d": 0.0, "rainfall_14d": 0.0, "rainfall_max_day": 0.0,
    "rainfall_days_7d": 0.0, "temp_max": 30.0, "temp_min": 20.0, "temp_mean": 25.0, "temp_range": 10.0,
    "temp_std": 2.0, "humidity": 65.0, "humidity_max": 80.0, "hot_days_7d": 0.0, "cold_days_7d": 0.0,
    "wet_days_7d": 0.0, "gdd_7d": 70.0, "gdd_14d": 140.0, "vpd_7d": 0.5,
}


def district_aliases() -> list[dict]:
    """Every accepted spelling with its canonical name."""
    rows = [{"alias": name.lower(), "canonical": name} for name in DISTRICTS]
    rows += [{"alias": alias, "canonical": name} for name, spellings in DISTRICT_VARIANTS.items()
             for alias in spellings]
    return rows
