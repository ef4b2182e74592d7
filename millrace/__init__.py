"""Analytics jobs expressed as Spark DataFrame transformations.

``operators`` holds column-name driven building blocks, ``plans`` the domain
jobs built from them, ``functions`` column expressions, ``sources``/``sinks``
the loads and exports around them and ``streaming`` the file pick-up.
"""
