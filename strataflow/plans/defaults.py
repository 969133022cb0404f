"""Names and constants of the country-year datasets.

Fixed values: they are part of stored results, so they must not vary.
"""

GDP_SOURCE = "world_bank_api"
CO2_SOURCE = "wikipedia_co2"
MAPPING_TAG = "world_bank"
OVERRIDE_TAG = "override"

RECORD_SCOPE = "world_bank_api"
TABLE_SCOPE = "wikipedia_co2"
CURATED_SCOPE = "curated_join"

RECORD_CHECKPOINT = "last_year_loaded_world_bank"
TABLE_CHECKPOINT = "last_revid_wikipedia_co2"

# The first header row of the HTML table is shorter than its body, so values sit
# under the header of another column: the year of each value by header.
LOCATION_HEADER = "Location"
VALUE_HEADERS = {
    "% change from 2000": 2000,
    "Emissions per capita (tons per year)": 2023,
}

REPORT_YEARS = (2000, 2023)
FIT_YEAR = 2023
OUTLIERS = 7
TOP_N = 5
REPORT_NAME = "correlation_summary"

# Manual names, as key, code, name; the name may hold commas.
COUNTRY_OVERRIDES = """\
country_name_normalized,country_code,country_name
bahamas,BHS,Bahamas, The
brunei,BRN,Brunei Darussalam
cape verde,CPV,Cabo Verde
czech republic,CZE,Czechia
democratic republic of the congo,COD,Congo, Dem. Rep.
east timor,TLS,Timor-Leste
egypt,EGY,Egypt, Arab Rep.
gambia,GMB,Gambia, The
hong kong,HKG,Hong Kong SAR, China
iran,IRN,Iran, Islamic Rep.
italy including san marino and vatican city,ITA,Italy
ivory coast,CIV,Cote d'Ivoire
kyrgyzstan,KGZ,Kyrgyz Republic
laos,LAO,Lao PDR
macao,MAC,Macao SAR, China
north korea,PRK,Korea, Dem. People's Rep.
puerto rico,PRI,Puerto Rico (US)
reunion,REU,Reunion
russia,RUS,Russian Federation
saint helena ascension and tristan da cunha,SHN,Saint Helena, Ascension and Tristan da Cunha
saint kitts and nevis,KNA,Saint Kitts and Nevis
saint lucia,LCA,Saint Lucia
saint pierre and miquelon,SPM,Saint Pierre and Miquelon
saint vincent and the grenadines,VCT,Saint Vincent and the Grenadines
serbia and montenegro,SCG,Serbia and Montenegro
slovakia,SVK,Slovak Republic
somalia,SOM,Somalia, Fed. Rep.
south korea,KOR,Korea, Rep.
spain including andorra,ESP,Spain
sudan south sudan,SDN,Sudan
switzerland including liechtenstein,CHE,Switzerland
syria,SYR,Syrian Arab Republic
"""
