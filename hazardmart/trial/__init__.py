"""The operators aimed at the bundled test tables, one query and one SQL text per operator.

Orders play the declarations: the nation of the customer is the state, the order year the year,
the market segment the phenomenon and the order status the declaration type. Line items supply
the municipality count and the population, the order price the cost.
"""
