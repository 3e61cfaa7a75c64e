"""Outline of the area an asset must lie in: simplified national boundary, mainland and three island groups."""

# Polygons -> rings -> (lon, lat); the first ring is the outer one, every ring is closed.
NATIONAL_BOUNDARY = (
    ((
        (17.16357139189, 80.13752006815), (18.33438156491, 79.72175976673), (20.15122008862, 79.38907949318),
        (21.29372927506, 79.05694907103), (21.6124906786, 78.88278560066), (21.66115531761, 78.68872792751),
        (21.35010366794, 78.66961253251), (21.18128764545, 78.6679796905), (21.01529007968, 78.64667270366),
        (19.95753772397, 78.5660052256), (17.85480075237, 76.83614604709), (16.3766486477, 76.36509089359),
        (13.20664534147, 77.53552154758), (11.93393612182, 78.0655305027), (10.00062579575, 78.74701064301),
        (10.51366641293, 79.12956257818), (10.00062579575, 79.82161623391), (14.31334901073, 79.98174250443),
        (15.43849774115, 80.09660038078), (17.16357139189, 80.13752006815),
    ),),
    ((
        (24.62165000161, 77.84573958874), (22.96713067756, 77.18737136031), (20.57401729426, 77.43051219201),
        (20.89792520777, 77.92905452573), (20.04197833452, 78.54186550655), (21.06184493371, 78.63908900826),
        (21.18747762747, 78.66621882871), (21.38432954871, 78.66886537168), (21.91950146687, 78.61092805091),
        (24.62165000161, 77.84573958874),
    ),),
    ((
        (31.13363253808, 70.56372939917), (31.40031531565, 70.19557638186), (31.60579048878, 69.76451691429),
        (30.00191976287, 69.17327491388), (28.81059197352, 68.93525924179), (28.45520953024, 69.19586273242),
        (28.51877296446, 69.56149790613), (27.63425043749, 69.96799712181), (26.145738087, 69.42790302504),
        (25.72359481731, 68.51091093412), (22.33193203395, 68.5079500145), (21.61449476227, 69.04110723237),
        (20.06483621353, 68.20316872074), (18.05199412997, 67.9181863794), (16.97686832921, 67.93926579413),
        (16.65359857718, 67.06664998825), (15.2552030244, 65.86556807947), (14.38650275676, 64.84976210799),
        (14.39957402778, 63.94698903866), (12.24765501867, 63.25808658242), (13.11356731496, 61.51824994522),
        (11.80637279075, 58.81096653764), (10.5515088923, 58.70081829238), (9.39796437291, 58.44184628181),
        (7.94623414079, 57.77118093422), (6.82245408487, 57.78647041991), (5.7544624297, 58.07830129712),
        (4.72486075569, 58.92026789606), (4.13083740234, 60.04291457017), (4.00447516789, 61.45734155945),
        (5.32128206468, 62.75617316054), (7.79709340954, 63.85951312858), (9.55808349609, 64.99794848737),
        (10.84813825198, 66.25246615918), (10.81052490234, 67.58410604758), (13.41507401189, 68.82160991307),
        (18.54585176101, 70.59166614546), (24.9009949206, 71.39859375094), (28.53996077586, 71.15593546776),
        (31.13363253808, 70.56372939917),
    ),),
    ((
        (28.75183888992, 80.12046565133), (26.8661236748, 79.55999791212), (24.83209377984, 79.04487604621),
        (20.93101536358, 79.27921995167), (19.75745556947, 79.49836760232), (18.30671397318, 79.756259177),
        (17.368015, 80.318896), (20.45555437514, 80.78548537651), (28.75183888992, 80.12046565133),
    ),),
)
