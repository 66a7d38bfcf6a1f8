"""Entry script for spark-submit (which runs a file, not ``-m``).

    zip -r starloom.zip starloom
    spark-submit --py-files starloom.zip submit.py build --arrivals ... --out ...

``--py-files`` puts the package on the driver's path (and the executors').
"""

from starloom.__main__ import main

if __name__ == "__main__":
    main()
