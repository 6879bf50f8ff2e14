"""Terms with what each rule makes of them, worked out by hand from the rules: at least one per rule."""

from __future__ import annotations

# term, date of lease, rule, start, expiry, tenure
CASES: list[tuple[str, str | None, str, str, str, float]] = [
    ("99 years from 24 June 1862", None, "3a", "1862-06-24", "1961-06-24", 99),
    ("99 years less 3 days from 25 March 1868", None, "3a", "1868-03-25", "1967-03-22", 99),
    ("215 years (less 3 days) from and including 24 June 1986", None, "3a", "1986-06-24", "2201-06-21", 215),
    ("97 3/4 years from 25 March 1866", None, "3a", "1866-03-25", "1963-12-25", 97.75),
    ("52 and a quarter years less 10 days from 25 March 1906", None, "3a", "1906-03-25", "1958-06-15", 52.25),
    ("99 years from Christmas Day 1900", None, "3a", "1900-12-25", "1999-12-25", 99),
    ("99 years less the last three days from Lady Day 1868", None, "3a", "1868-03-25", "1967-03-22", 99),
    ("500 years less 9 months from 29 September 1585", None, "3a", "1585-09-29", "2084-12-29", 500),
    ("199 years (less 14 days) from 16 Jnuary 2006", None, "3a", "2006-01-16", "2205-01-02", 199),
    ("199 years from 12:7:1973", None, "3a", "1973-07-12", "2172-07-12", 199),
    ("99 years (subject to review) from 24 June 1990", None, "3a", "1990-06-24", "2089-06-24", 99),
    ("99 years from 29 February 2000", None, "3a", "2000-02-29", "2099-02-28", 99),
    ("one year from and including 6 June 2023 to and including 5 June 2024", None, "1", "2023-06-06", "2024-06-05", 1),
    ("Beginning on and including 1 September 2016 ending on and including 2 August 3015", None, "2a", "2016-09-01", "3015-08-02", 999),
    ("From 23/5/1988 to 31/4/2114", None, "2a", "1988-05-23", "2114-04-30", 126),
    ("on and from 1 June 1990 until and including the 31 May 2015", None, "2a", "1990-06-01", "2015-05-31", 25),
    ("5 June 2002 until 31 December 3001", None, "2b", "2002-06-05", "3001-12-31", 999),
    ("Expiring on 21 October 2115 from 22 October 1990", None, "2c", "1990-10-22", "2115-10-21", 125),
    ("From and including 10 May 2013 for a term of years expiring on 9 December 2190", None, "2d", "2013-05-10", "2190-12-09", 177),
    ("From 1 January 2000 and expiring on the expiration of 99 years from 25 December 1999", None, "2e", "2000-01-01", "2098-12-24", 99),
    ("From and including 25 March 1990 for the term of 99 years less 3 days", None, "3b", "1990-03-25", "2089-03-22", 99),
    ("31 years and 6 months from 28 March 2024", None, "3c", "2024-03-28", "2055-09-28", 31),
    ("From and including 90 years from 2 December 2024", None, "4a", "2024-12-02", "2114-12-01", 90),
    ("commencing on 10 may 2013 for a term of 125 years", None, "4b", "2013-05-10", "2138-05-09", 125),
    ("From 1 May 2001 for a term of 125 years", None, "4c", "2001-05-01", "2126-04-30", 125),
    ("147 years expiring on 23 June 2161", None, "4d", "2014-06-23", "2161-06-23", 147),
    ("Commences on 28 July 2024 and expires 50 years thereafter", None, "4e", "2024-07-28", "2074-07-27", 50),
    ("999 years from and including December 2023", None, "4f", "2023-12-01", "3022-11-30", 999),
    ("999 years 25 March 1896", None, "5a", "1896-03-25", "2895-03-24", 999),
    ("999 from 27 April 2006", None, "5b", "2006-04-27", "3005-04-26", 999),
    ("999 and 1 day from 28 March 1988", None, "5c", "1988-03-28", "2987-03-29", 999),
    ("999 years from the date of the lease", "16-10-1866", "6a", "1866-10-16", "2865-10-15", 999),
    ("125 years from date hereof", "01/02/1999", "6a", "1999-02-01", "2124-01-31", 125),
    ("For a term expiring on the 31st day of March 2122", "01-04-1900", "6b1", "1900-04-01", "2122-03-31", 222),
    ("For a term of years expiring on 31 March 2122", "01-04-1997", "6b2", "1997-04-01", "2122-03-31", 125),
    ("Expiring on 24 June 2050", "24/06/1951", "6c", "1951-06-24", "2050-06-24", 99),
    ("a term of 99 years", "05.06.1990", "6d", "1990-06-05", "2089-06-04", 99),
    ("999 (less 10 days)", "01-01-1900", "6d2", "1900-01-01", "2898-12-31", 999),
    ("99 years commencing on", "05-06-1990", "6e", "1990-06-05", "2089-06-04", 99),
    ("Beginning on and including the date of this lease and ending on 30 June 2120", "01-07-2020", "6f", "2020-07-01", "2120-06-30", 100),
    ("From and including the date of the lease up to 31 December 2140", "01-01-2016", "6f2", "2016-01-01", "2140-12-31", 125),
    ("From and including 30 September to and including 29 September 2031", "30-09-2020", "6g", "2020-09-30", "2031-09-29", 11),
    ("18 April 1997", "01-01-1900", "6h", "1900-01-01", "1997-04-18", 97),
]
