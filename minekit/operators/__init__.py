"""Mining operators: each takes DataFrames (plus a few parameters) and
returns a DataFrame; only model parameters of bounded size reach the driver."""
