"""careledger: retail and CRM analytics on Spark DataFrames.

Queries live in ``careledger.plans`` (one function per dashboard query); each
takes the retail ``Sources``, an ``as_of`` date and typed parameters and
returns a lazy DataFrame.
"""
