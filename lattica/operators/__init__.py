"""Plans to DataFrames.  Everything here is lazy: Catalyst optimises, Spark executes."""
