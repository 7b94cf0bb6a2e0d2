"""The two raw input tables of the provider load, 15 rows each."""

from datetime import date, datetime

REGISTRY_LOADED = datetime(2026, 6, 17, 21, 52, 17, 950000)
SPECIALTY_LOADED = datetime(2026, 6, 17, 21, 52, 18, 812000)

# npi, first, last, name, credential, gender, state, zip, taxonomy, phone, enumerated, address, city, tin
_REGISTRY = [
    ("1234567890", "JOHN", "SMITH", "JOHN SMITH MD", "MD", "M", "PA", "19101", "207Q00000X", "2155551001", "2010-01-15", "123 Main Street", "Philadelphia", "123-45-6789"),
    ("2345678901", "JANE", "DOE", "JANE DOE DO", "DO", "F", "NY", "10001", "208000000X", "2125551002", "2011-03-20", "456 Oak Avenue", "New York", "234-56-7890"),
    ("3456789012", "ROBERT", "WILSON", "ROBERT WILSON NP", "NP", "M", "CA", "90001", "363L00000X", "4155551003", "2012-06-10", "789 Pine Blvd", "Los Angeles", "345-67-8901"),
    ("4567890123", "MARIA", "GARCIA", "MARIA GARCIA MD", "MD", "F", "TX", "75001", "207R00000X", "2145551004", "2013-09-05", "321 Elm Drive", "Houston", "456-78-9012"),
    ("5678901234", "DAVID", "LEE", "DAVID LEE DO", "DO", "M", "FL", "33101", "208600000X", "3055551005", "2014-02-28", "654 Maple Lane", "Miami", "567-89-0123"),
    ("6789012345", "SARAH", "JOHNSON", "SARAH JOHNSON MD", "MD", "F", "IL", "60601", "207Q00000X", "3125551006", "2015-04-12", "987 Cedar Court", "Chicago", "678-90-1234"),
    ("7890123456", "MICHAEL", "BROWN", "MICHAEL BROWN NP", "NP", "M", "OH", "43001", "363A00000X", "6145551007", "2016-07-01", "147 Birch Road", "Columbus", "789-01-2345"),
    ("8901234567", "LISA", "ANDERSON", "LISA ANDERSON MD", "MD", "F", "WA", "98101", "207V00000X", "2065551008", "2017-11-18", "258 Walnut Way", "Seattle", "890-12-3456"),
    ("9012345678", "JAMES", "TAYLOR", "JAMES TAYLOR DO", "DO", "M", "MA", "02101", "208000000X", "6175551009", "2018-08-22", "369 Cherry Parkway", "Boston", "901-23-4567"),
    ("0123456789", "EMILY", "DAVIS", "EMILY DAVIS MD", "MD", "F", "CO", "80201", "207Q00000X", "3035551010", "2019-05-30", "741 Aspen Circle", "Denver", "012-34-5678"),
    (None, None, None, None, "MD", "M", "PA", "19102", "207Q00000X", "2155551011", "2020-01-01", None, None, None),
    ("12345", "THOMAS", "CLARK", "THOMAS CLARK MD", "MD", "M", "PENN", "19103", "207R00000X", "2155551012", "2020-02-01", "285 Willow Drive", "Pittsburgh", "BADTIN"),
    ("1111111111", None, None, "", "MD", "M", "NY", "10002", "208000000X", "2125551013", "2020-03-01", "852 Spruce Terrace", "Buffalo", "111-22-3333"),
    ("2222222222", "KAREN", "WHITE", "KAREN WHITE NP", "NP", "F", "NJ", "07001", "363L00000X", None, "2020-04-01", "963 Hickory Path", "Newark", "222-33-4444"),
    ("3333333333", "PETER", "HALL", "PETER HALL MD", "MD", "M", "CT", "06001", None, "2035551015", "2020-05-01", "174 Poplar Street", "Hartford", "333-44-5555"),
]

# code, name, category, board certification required, state, effective, expiration
_SPECIALTIES = [
    ("207Q00000X", "FAMILY MEDICINE", "Primary Care", "Y", "PA", "2010-01-01", "2030-12-31"),
    ("208000000X", "PEDIATRICS", "Primary Care", "Y", "NY", "2010-01-01", "2030-06-30"),
    ("207R00000X", "INTERNAL MEDICINE", "Primary Care", "Y", "TX", "2010-01-01", "2028-06-30"),
    ("363L00000X", "NURSE PRACTITIONER", "Advanced Practice", "N", "CA", "2010-01-01", "2031-06-30"),
    ("208600000X", "SURGERY", "Surgical", "Y", "FL", "2010-01-01", "2029-12-31"),
    ("207V00000X", "OBSTETRICS", "Surgical", "Y", "WA", "2010-01-01", "2027-12-31"),
    ("363A00000X", "PHYSICIAN ASSISTANT", "Advanced Practice", "N", "OH", "2010-01-01", "2030-03-31"),
    ("2084N0400X", "NEUROLOGY", "Specialty", "Y", "IL", "2010-01-01", "2028-12-31"),
    ("207X00000X", "ORTHOPEDICS", "Surgical", "Y", "MA", "2010-01-01", "2031-01-01"),
    ("207Y00000X", "OPHTHALMOLOGY", "Specialty", "Y", "CO", "2010-01-01", "2029-09-30"),
    (None, "CARDIOLOGY", "Specialty", "Y", "PA", "2015-01-01", None),
    ("2086S0129X", "VASCULAR SURGERY", "Specialty", "Y", "NY", "2015-01-01", None),
    ("207RC0000X", "CARDIOVASCULAR", "Specialty", "Y", "TX", "2015-01-01", None),
    ("208C00000X", "DERMATOLOGY", "Specialty", "Y", "NJ", "2015-01-01", None),
    ("207RI0200X", "INFECTIOUS DISEASE", "Specialty", "Y", "CT", "2015-01-01", "2029-03-15"),
]


def _date(text):
    return date.fromisoformat(text) if text else None


def registry_rows(loaded=REGISTRY_LOADED):
    return [
        (*r[:10], "N", _date(r[10]), "NPI_REGISTRY", loaded, *r[11:])
        for r in _REGISTRY
    ]


def specialty_rows(loaded=SPECIALTY_LOADED):
    return [(*r[:5], _date(r[5]), _date(r[6]), "CMS_TAXONOMY", loaded) for r in _SPECIALTIES]
