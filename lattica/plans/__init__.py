"""Query plans: data that says what is asked for; operators/ turns them into DataFrames."""
