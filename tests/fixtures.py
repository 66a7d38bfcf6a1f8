"""Invented inputs in the shapes of the reference's sources (no real rows)."""

from __future__ import annotations

import os

from starloom import schemas

DICTIONARY = """options made_up ;

/* codes of an invented land survey */

/* part one: lands */
  value i94cntyl
   101 =  'FIRSTLAND'
   236 =  'NORTH ELBONIA'
    0  =  'NO COUNTRY (0)'
   102 =  'O''BRIENIA'
   999 =  'LASTLAND' ;


/* part two: landing places */
  value $i94prtl
   'ABC'\t=\t'ALPHA CITY, AK             '
   'ABD'\t=\t'BRAVO TOWN, AK'
   'WDC'\t=\t'CAPITOL DC         '
   'XYZ' \t=\t'No PORT Code (XYZ)'
   'AG'\t=\t'AGUA, MX'
   'CP '\t=\t'CAPE POINT, CA'
   '.GA'\t=\t'DOT PORT, GA'
   'OMA'\t=\t'O''MALLEY POINT, MN'
   'SPX'\t=\t'SPRINGS,CO'
   'PRT'\t=\t'PORTVILLE, ME'
   'PRO'\t=\t'PORTVILLE, OR'
   'ALC'\t=\t'ALPHA CITY, AK'
   'BRK'\t=\t'BROOK, NY (BPS)'
   'HSH'\t=\t'HASHTON, WA #INTL'
   'TWO'\t=\t'LAKE, NORTH SHORE, MI'
   'UNK'\t=\t'UNKNOWN  '
;


/* days are counted, see the manual */


/* part three: ways to travel */
value i94model
\t1 = 'Balloon'
\t2 = 'Raft'
\t3 = 'Mule'
\t9 = 'Unknown way' ;
\t

/* part four: provinces; unlisted ones don't count */
value i94addrl
\t'AK'='ALDER KEEP'
\t'CA'='CANYON'
\t'CO'='COPPER'
\t'DC'='DOVE COUNTY'
\t'GA'='GARDEN'
\t'ME'='MEADOW'
\t'MI'='MIDLAND'
\t'MN'='MOON'
\t'NY'='NORTH YARD'
\t'OR'='ORCHARD'
\t'WA'='WATER'
\t'99'='Elsewhere' ;

/* reasons, told in prose only:
   1 = 'Trips'
   2 = Leisure
*/
run ;
"""

COUNTRIES = {101: "FIRSTLAND", 236: "NORTH ELBONIA", 0: "NO COUNTRY (0)",
             102: "O'BRIENIA", 999: "LASTLAND"}

# code -> (city, state)
PORTS = {
    "ABC": ("ALPHA CITY", "AK"), "ABD": ("BRAVO TOWN", "AK"), "WDC": ("CAPITOL", "DC"),
    "XYZ": ("No PORT Code (XYZ)", None), "AG": ("AGUA, MX", None),
    "CP": ("CAPE POINT", "CA"), ".GA": ("DOT PORT", "GA"), "OMA": ("O'MALLEY POINT", "MN"),
    "SPX": ("SPRINGS", "CO"), "PRT": ("PORTVILLE", "ME"), "PRO": ("PORTVILLE", "OR"),
    "ALC": ("ALPHA CITY", "AK"), "BRK": ("BROOK", "NY"), "HSH": ("HASHTON", "WA"),
    "TWO": ("LAKE, NORTH SHORE", "MI"), "UNK": ("UNKNOWN", None),
}

N_STATES = 12
N_MODES = 4

DEMOGRAPHICS = """City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
Alpha City;Alaska;33.1;1000;1100;2100;50;400;2.5;AK;White;900
Alpha City;Alaska;33.1;1000;1100;2100;50;400;2.5;AK;Asian;300
Alpha City;Alaska;33.1;1000;1100;2100;50;400;2.5;AK;Black;200
Capitol;District of Columbia;35.0;3000;3100;6100;70;2000;2.1;DC;White;500
Capitol;District of Columbia;35.0;3000;3100;6100;70;2000;2.1;DC;Black;500
Portville;Maine;40.2;400;420;820;30;100;2.2;ME;White;700
Portville;Oregon;36.3;5000;5100;10100;90;900;2.4;OR;White;800
Brook;New York;31.0;9000;9500;18500;120;5000;2.9;NY;Asian;
Brook;New York;31.0;9000;9500;18500;120;5000;2.9;NY;White;600
Nowhere;Kansas;45.0;10;12;22;1;0;1.9;KS;White;100
HashTon;Washington;38.0;700;710;1410;40;300;2.3;WA;White;50
Springs;Colorado;;;;;;;;CO;White;300
"""

AIRPORTS = """ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates
00A,heliport,Alpha Pad,11,NA,US,US-AK,Alpha City,00A,,00A,"-74.93, 40.07"
00B,small_airport,Bravo Field,,NA,US,US-CA,,00B,,00B,"-1.5, 2.5"
00C,closed,Odd Region,5,NA,US,US-U-A,Somewhere,,,,"3.0, 4.0"
XX1,small_airport,Foreign Field,100,EU,FR,FR-75,Paris,,,,"2.3, 48.8"
"""

BASE = dict(cicid=None, i94yr=2016.0, i94mon=4.0, i94cit=101.0, i94res=236.0,
            i94port="ABC", arrdate=20574.0, i94mode=1.0, i94addr="AK", depdate=20580.0,
            i94bir=30.0, i94visa=2.0, count=1.0, dtadfile=None, visapost=None, occup=None,
            entdepa=None, entdepd=None, entdepu=None, matflag=None, biryear=1986.0,
            dtaddto=None, gender="F", insnum=None, airline="ZZ", admnum=None,
            fltno="00101", visatype="B2")

REQUIRED = ["depdate", "i94addr", "fltno", "airline", "visatype", "gender", "i94cit", "i94res"]


def arrival_rows():
    def r(cicid, **kw):
        d = dict(BASE, cicid=float(cicid), admnum=5550000.0 + cicid)
        d.update(kw)
        return d
    rows = [
        r(1, i94visa=1.0, arrdate=20574.5),                      # kept, noon arrival
        r(2, gender="M"),                                         # kept
        r(3, i94port="WDC", i94cit=555.0, i94visa=3.0),           # unknown country
        r(4, i94port="ZZZ", i94visa=4.0),                         # unknown port, visa 4
        r(5, i94mode=2.0), r(6, i94mode=3.0), r(7, i94mode=9.0), r(8, i94mode=None),
    ]
    rows += [r(9 + i, **{c: None}) for i, c in enumerate(REQUIRED)]  # 9..16 dropped
    rows += [
        r(17, arrdate=None),                                      # NULL arrival kept
        r(1, i94mon=5.0, i94port="PRT", admnum=5550101.0),        # same cicid, next month
        r(19, admnum=5550002.0, fltno="00202", gender="M"),       # same admnum, 2nd flight
        r(2, gender="M"),                                         # exact duplicate of 2
        r(21, i94visa=None, i94port="WDC"),                       # NULL visa kept
    ]
    return rows


KEPT_CICIDS = [1, 2, 3, 4, 17, 1, 19, 2, 21]


def write_inputs(spark, root: str) -> dict:
    os.makedirs(root, exist_ok=True)
    paths = {"dictionary": f"{root}/labels.txt", "demographics": f"{root}/demog.csv",
             "airports": f"{root}/airports.csv", "arrivals": f"{root}/arrivals"}
    for key, text in [("dictionary", DICTIONARY), ("demographics", DEMOGRAPHICS),
                      ("airports", AIRPORTS)]:
        with open(paths[key], "w") as fh:
            fh.write(text)
    rows = arrival_rows()
    cols = schemas.ARRIVALS_RAW.fieldNames()
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schemas.ARRIVALS_RAW)
    df.repartition(3).write.mode("overwrite").parquet(paths["arrivals"])
    return paths
