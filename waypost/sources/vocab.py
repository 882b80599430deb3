"""Fixed vocabularies of the two input tables.

The airport directory has several hundred entries and changes over time, so it
is not listed here: pass it as a table (see ``sources.dims.airports``).
"""

# Raw header -> canonical header.
COLUMN_NAMES = {
    "OCCORRENZE": "OCCURRENCES",
    "AREOPORTO_ARRIVO": "ARRIVAL_AIRPORT_IATA",
    "AREOPORTO_PARTENZA": "DEPARTURE_AIRPORT_IATA",
    "ANNO_PARTENZA": "DEPARTURE_YEAR",
    "MESE_PARTENZA": "DEPARTURE_MONTH",
    "DATA_PARTENZA": "DEPARTURE_DATE",
    "DESCR_AEREOPORTO_ARR": "ARRIVAL_AIRPORT_DESCRIPTION",
    "DESCR_AEREOPORTO_PART": "DEPARTURE_AIRPORT_DESCRIPTION",
    "CITTA_ARR": "ARRIVAL_CITY",
    "CITTA_PARTENZA": "DEPARTURE_CITY",
    "CODICE_PAESE_ARR": "ARRIVAL_COUNTRY_CODE",
    "CODICE_PAESE_PART": "DEPARTURE_COUNTRY_CODE",
    "PAESE_ARR": "ARRIVAL_COUNTRY",
    "PAESE_PART": "DEPARTURE_COUNTRY",
    "ZONA": "ZONE",
    "TOT": "TOTAL",
    "MOTIVO_ALLARME": "ALARM_REASON",
    "note_operatore": "OPERATOR_NOTES",
    "flag_rischio": "RISK_FLAG",
    "Paese Partenza": "DEPARTURE_COUNTRY_FULL",
    "CODICE PAESE ARR": "ARRIVAL_COUNTRY_CODE_FULL",
    "3zona": "ZONE_3",
    "paese%arr": "ARRIVAL_COUNTRY_PERCENTAGE",
    "tot voli": "TOTAL_FLIGHTS",
    "NAZIONALITA": "NATIONALITY",
    "GIORNO_PARTENZA": "DEPARTURE_DAY",
    "ENTRATI": "ENTRIES",
    "INVESTIGATI": "INVESTIGATED",
    "ALLARMATI": "ALARMS",
    "TIPO_DOCUMENTO": "DOCUMENT_TYPE",
    "GENERE": "GENDER",
    "FASCIA_ETA": "AGE_GROUP",
    "FLAG_TRANSITO": "TRANSIT_FLAG",
    "COMPAGNIA_AEREA": "AIRLINE",
    "NUMERO_VOLO": "FLIGHT_NUMBER",
    "ESITO_CONTROLLO": "CONTROL_OUTCOME",
    "codice_rischio": "RISK_CODE",
    "Tipo_Documento": "DOCUMENT_TYPE2",
    "Tipo Documento": "DOCUMENT_TYPE2",
    "FASCIA_ETA2": "AGE_GROUP2",
    "FASCIA ETA": "AGE_GROUP2",
    "3nazionalita": "NATIONALITY_3",
    "compagnia%aerea": "AIRLINE%",
    "num volo": "FLIGHT NUMBER",
}

# Raw occurrence label (lower case) -> vocabulary value.
OCCURRENCES = {
    "viaggiatori entrati nel sistema": "entries",
    "voli disponibili in ingresso al sistema": "available_inbound_flights",
    "voli solo visualizzati, ma non investigati": "viewed_not_investigated_flights",
    "voli investigati (sdi/nsis - interpol - tsc)": "investigated_flights",
    "viaggiatori investigati": "investigated_entries",
    "voli con allarmi": "flights_with_alerts",
    "viaggiatori con allarmi": "entries_with_alerts",
    "allarmi generati da sdi/nsis": "generated_alerts",
    "allarmi generati da bcs": "generated_alerts",
    "allarmi generati da interpol": "generated_alerts",
    "allarmi generati": "generated_alerts",
    "allarmi chiusi": "closed_alerts",
    "allarmi chiusi con azione (cc.xx)": "closed_alerts",
    "allarmi rilevanti": "relevant_alerts",
    "allarmi non chiusi": "open_alerts",
    "nulla a procedere sdi": "negative_outcome",
    "nulla a procedere nsis": "negative_outcome",
    "nulla a procedere int": "negative_outcome",
    "errata segnalazione sdi": "negative_outcome",
    "errata segnalazione nsis": "negative_outcome",
    "errata segnalazione bcs": "negative_outcome",
    "respinto/a": "negative_outcome",
    "mancato aggiornamento sdi": "missing_update",
    "mancato aggiornamento schengen nsis": "missing_update",
    "notifica atti/provv": "other",
    "inammissibilita schengen - art.24": "other",
    "altro": "other",
}

# Italian country name -> ISO 3166 alpha-3.
COUNTRY_ISO3 = {
    "Albania": "ALB", "Algeria": "DZA", "Antigua e Barbuda": "ATG",
    "Arabia Saudita": "SAU", "Argentina": "ARG", "Armenia": "ARM",
    "Azerbaigian": "AZE", "Bahrain": "BHR", "Brasile": "BRA", "Canada": "CAN",
    "Capo Verde": "CPV", "Cina": "CHN", "Corea del Sud": "KOR", "Cossovo": "RKS",
    "Egitto": "EGY", "Emirati Arabi Uniti": "ARE", "Etiopia": "ETH",
    "Georgia": "GEO", "Giamaica": "JAM", "Giappone": "JPN", "Giordania": "JOR",
    "Hong Kong": "HKG", "India": "IND", "Iran": "IRN", "Israele": "ISR",
    "Kazakistan": "KAZ", "Kenya": "KEN", "Kuwait": "KWT", "Libano": "LBN",
    "Libia": "LBY", "Macedonia": "MKD", "Maldive": "MDV", "Marocco": "MAR",
    "Mauritius": "MUS", "Messico": "MEX", "Moldavia": "MDA", "Montenegro": "MNE",
    "Oman": "OMN", "Qatar": "QAT", "Regno Unito": "GBR",
    "Repubblica Dominicana": "DOM", "Senegal": "SEN", "Serbia": "SRB",
    "Singapore": "SGP", "Stati Uniti": "USA", "Taiwan": "TWN",
    "Tanzania": "TZA", "Tunisia": "TUN", "Turchia": "TUR", "Uzbekistan": "UZB",
    "Afghanistan": "AFG", "Angola": "AGO", "Australia": "AUS",
    "Bosnia Herzegovina": "BIH", "Bulgaria": "BGR", "Burkina Faso": "BFA",
    "Camerun": "CMR", "Cile": "CHL", "Colombia": "COL",
    "Congo (Kinshasa)": "COD", "Costa d'Avorio": "CIV", "Eritrea": "ERI",
    "Filippine": "PHL", "Germania": "DEU", "Grecia": "GRC",
    "Guinea-Bissau": "GNB", "Indonesia": "IDN", "Kirghizistan": "KGZ",
    "Madagascar": "MDG", "Malesia": "MYS", "Mozambico": "MOZ", "Nigeria": "NGA",
    "Nuova Zelanda": "NZL", "Pakistan": "PAK", "Russia": "RUS",
    "Sudafrica": "ZAF", "Svezia": "SWE", "Thailandia": "THA",
    "Turkmenistan": "TKM", "Vietnam": "VNM",
}

# Tokens that stand for "missing" (compared lower case, trimmed).
PLACEHOLDERS = [
    "n.d.", "?", "", "//", "-", "unknown", "nd", "n/a", "null", "unk",
    "zz", "none", "xx", "???", "eu", "nan",
]

# The same tokens as they are compared, case and all, on nationality.
NATIONALITY_PLACEHOLDERS = [
    "n.d.", "?", "", "//", "-", "unknown", "nd", "n/a", "null", "unk",
    "zz", "none", "xx", "???", " ", "ND", "UNK", "XX", "ZZ", "EU",
]

# Spellings of "unknown" that stay a category, and junk that does not.
UNKNOWN_VARIANTS = ["ND", "UNKNOWN", "UNKN", "N/A", "N/C"]
JUNK_TOKENS = ["-", "//", "?", "???", "XX", "ZZ", "NAN", ""]

# Gender, transit and risk recodes.
GENDER = {
    "MASCHIO": "M", "MALE": "M", "1": "M",
    "FEMMINA": "F", "FEMALE": "F", "2": "F",
    " ": "N.D.", "-": "N.D.", "//": "N.D.", "X": "N.D.",
    "N/B": "N.D.", "ND": "N.D.", "UNKNOWN": "N.D.", "UNKN": "N.D.", "?": "N.D.",
}
TRANSIT = {
    "SINGOLA TRATTA": "1", "MULTITRATTA": "2",
    "TRIPLA TRATTA": "3", "TRANSITO": "STOPOVER",
}
RISK = {"ALTO": "HIGH RISK", "MEDIO": "MEDIUM RISK"}
RISK_DEFAULT = "LOW RISK"

# Year, month and country-code recodes.
YEARS = {"2024.": "2024", "24": "2024", "anno 2024": "2024", "ANNO 2024": "2024"}
MONTHS_IT = {
    "GEN": "01", "FEB": "02", "MAR": "03", "APR": "04", "MAG": "05", "GIU": "06",
    "LUG": "07", "AGO": "08", "SET": "09", "OTT": "10", "NOV": "11", "DIC": "12",
}
MONTHS_EN = {
    "JAN": "01", "FEB": "02", "MAR": "03", "APR": "04", "MAY": "05", "JUN": "06",
    "JUL": "07", "AUG": "08", "SEP": "09", "OCT": "10", "NOV": "11", "DEC": "12",
}
COUNTRY_CODES = {"IT": "ITA"}

# Free-text defaults and zone sentinels.
NO_REASON = "NO REASON PROVIDED"
NO_MANUAL_NOTES = "NO MANUAL NOTES"
NO_NOTES = "NO_NOTES"
ZONE_SENTINELS = ["-1", "99", "??"]

# Limits.
SIGNAL_CAP = 200
FLIGHT_CAP = 1000
CONTAMINATION = 0.05
PANEL_CONTAMINATION = 0.03
SEED = 42
MIN_ROUTES = 10
MIN_PANEL_ROWS = 30

# Request words that are never airport codes, and arrival keywords.
REQUEST_STOP_WORDS = ["AND", "FOR", "THE", "FROM", "WITH", "ALL", "VIA", "ANY", "TO"]
ARRIVAL_WORDS = ["to", "arrival", "arriving", "arriva", "atterra", "verso"]

# Quality notes and risk levels.
NOTE_INCOMPLETE = "incomplete data — alarms but no traveler records"
NOTE_FALSE_POSITIVE = "likely false positive — flagged on non-rate features"
NOTE_TINY_VOLUME = "warning — high rate but tiny volume (≤3 investigated)"
NOTE_OK = "ok"
DISQUALIFYING = [NOTE_INCOMPLETE, NOTE_FALSE_POSITIVE]
RISK_LEVELS = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
