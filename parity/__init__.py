"""Every operator as a query over the test tables, and the SQL that must agree."""

# Added to every double before it is rounded to six digits, on both sides.  Scores
# have short decimal weights and so hit exact ties at the seventh digit, which the
# two engines round by the last bit of the sum; a shift far above that bit and far
# below the sixth digit decides all ties alike.
TIE_NUDGE = 3.7e-10
